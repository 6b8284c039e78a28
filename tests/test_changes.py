import base64
import hashlib
import os

from inkwell.operators import changes as C
from inkwell.session import work_dir


def test_file_signatures_and_diff(spark):
    root = work_dir(spark, "t-files")
    local = root[len("file:"):] if root.startswith("file:") else root
    os.makedirs(local)
    data = {"a.txt": b"hello", "b.txt": b"world"}  # Spark file scans skip empty files
    for n, b in data.items():
        with open(os.path.join(local, n), "wb") as f:
            f.write(b)
    md5 = {r.path.rsplit("/", 1)[1]: r.signature for r in C.file_signatures(spark, root, "MD5").collect()}
    for n, b in data.items():
        assert md5[n] == base64.b64encode(hashlib.md5(b).digest()).decode().rstrip("=")
    ck = {r.path.rsplit("/", 1)[1]: r.signature for r in C.file_signatures(spark, root, "checksum").collect()}
    assert ck["a.txt"] == str(sum(b"hello") % 0xFFFFFFFF)
    rows = spark.createDataFrame([("e", ""), ("n", None)], "path string, content string")
    empty = {r.path: r.signature for r in C.content_signatures(rows, "checksum").collect()}
    assert empty == {"e": None, "n": None}
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("n", None), ("r", "9")],
                                "path string, signature string")
    new = spark.createDataFrame([("a", "1"), ("b", "3"), ("n", None), ("c", "4")],
                                "path string, signature string")
    got = sorted((r.path, r.change) for r in C.diff_signatures(old, new).collect())
    assert got == [("b", "changed"), ("c", "added"), ("r", "removed")]


def test_modification_time_follows_the_file(spark, tmp_path):
    import os

    from inkwell.operators import changes as C
    for name, at in (("a.txt", 1_000_000), ("b.txt", 2_000_000)):
        (tmp_path / name).write_text("x")
        os.utime(tmp_path / name, (at, at))
    read = lambda: {r["path"].rsplit("/", 1)[1]: r["signature"] for r in C.file_signatures(spark, str(tmp_path), "mtime").collect()}
    assert read() == {"a.txt": "1000000", "b.txt": "2000000"}
    os.utime(tmp_path / "a.txt", (3_000_000, 3_000_000))
    assert read()["a.txt"] == "3000000"


def test_all_digests_equal_hashlib(spark):
    import base64
    import hashlib

    from inkwell.operators import changes as C
    df = spark.createDataFrame([("p", "content é")], "path string, content string")
    for method, h in (("MD5", "md5"), ("SHA-1", "sha1"), ("SHA-256", "sha256"), ("SHA-512", "sha512")):
        want = base64.b64encode(hashlib.new(h, "content é".encode()).digest()).decode().rstrip("=")
        assert C.content_signatures(df, method).first()["signature"].replace("\r\n", "") == want


def test_stored_bytes_equal_the_listing(spark, tmp_path):
    import os

    from inkwell.operators.postings import stored_bytes
    spark.range(100).write.parquet(f"{tmp_path}/x")
    sizes = [os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(tmp_path) for f in fs if f[0] not in "._"]
    got = stored_bytes(spark, str(tmp_path)).first()
    assert (got["n_files"], got["stored_bytes"]) == (len(sizes), sum(sizes))


def test_document_records(spark, tmp_path):
    """Several DOC elements in a file, one DOCNO in two files, missing and
    empty elements, entities, accents, DOCNO without a number."""
    from inkwell.sources import corpus as CO
    (tmp_path / "a.xml").write_text(
        "<DOCS><DOC><DOCNO>\n10\n</DOCNO><TITLE>old</TITLE><TEXT>x</TEXT></DOC>"
        "<DOC><DOCNO>A1B2</DOCNO><TITLE/><AUTHOR>é &amp; ü</AUTHOR><TEXT>y</TEXT></DOC>"
        "<DOC><DOCNO>none</DOCNO><TEXT>u</TEXT></DOC><DOC><DOCNO>-</DOCNO><TEXT>v</TEXT></DOC></DOCS>")
    (tmp_path / "b.xml").write_text("<DOC><DOCNO>doc-10</DOCNO><TITLE>new</TITLE><TEXT>z</TEXT></DOC>")
    docs = CO.build_docs(CO.read_xml_docs(spark, str(tmp_path)), ["file_path"])
    got = sorted((str(r["doc_id"]), r["title"], r["author"], r["text"]) for r in docs.collect())
    assert got == [("10", "new", "", "new\nz\n"), ("12", "", "é & ü", "\ny\né & ü"),
                   ("None", "", "", "\nu\n"), ("None", "", "", "\nv\n")]


def test_staged_signatures_digest_only_suspicious_files(spark):
    """Same rows as signing everything; kept, changed, added, null, empty and
    equally long contents, another method for a file."""
    schema = "path string, content string, method string"
    old = [("keep", "abc", "MD5"), ("same-length", "abc", "MD5"), ("gone", "x", "MD5"), ("null", None, "MD5"),
           ("to-null", "y", "MD5"), ("from-null", None, "SHA-256"), ("empty", "", "checksum"), ("method", "m", "MD5")]
    new = [("keep", "abc", "MD5"), ("same-length", "abd", "MD5"), ("new", "x", "SHA-1"), ("null", None, "MD5"),
           ("to-null", None, "MD5"), ("from-null", "", "SHA-256"), ("empty", "", "checksum"),
           ("method", "m", "SHA-256")]
    of = lambda rows: spark.createDataFrame(rows, schema)
    first = C.staged_signatures(of(old))
    assert all(r.digested for r in first.collect())
    second = C.staged_signatures(of(new), first)
    whole = {(r.path, r.method, r.signature) for r in C.content_signatures(of(new)).collect()}
    assert {(r.path, r.method, r.signature) for r in second.collect()} == whole
    assert {r.path for r in second.collect() if not r.digested} == {"keep", "null", "empty"}
    got = {r.change: (r.n_files, r.n_digested) for r in C.digests_by_change(first, second).collect()}
    assert got == {"unchanged": (3, 0), "changed": (4, 4), "added": (1, 1), "removed": (1, 0)}
    none = C.staged_signatures(of([]), first)
    assert none.count() == 0
    assert C.staged_signatures(of([])).count() == 0
