"""Content signatures as column expressions (change detection).

Digests are base64 without padding, like the watched-file signatures of the
source system; the checksum is the byte sum modulo 2^32 - 1 (null for empty
content).  Digests are built-in expressions; the byte sum is an Arrow-batched
pandas UDF doing one numpy sum per row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

# Signature methods and the checksum modulus.
METHODS = ["MD5", "SHA-1", "SHA-256", "SHA-512", "checksum", "mtime"]
CHECKSUM_MOD = 0xFFFFFFFF
SCALAR_PATTERN = r"^([^|]+)\|([^|]+)\|(.+)$"


def _b64_nopad(hex_digest: Column) -> Column:
    return F.regexp_replace(F.base64(F.unhex(hex_digest)), "=+$", "")


def _bytes(content: Column) -> Column:
    return F.when(content.isNull(), F.lit(None).cast("binary")).otherwise(content.cast("binary"))


@F.pandas_udf(LongType())
def _byte_sum(b: pd.Series) -> pd.Series:
    # one vectorised numpy sum per row (Arrow batches), not a lambda per byte
    return pd.Series([None if (x is None or len(x) == 0)
                      else int(np.frombuffer(x, dtype=np.uint8).sum(dtype=np.uint64)) % CHECKSUM_MOD
                      for x in b], dtype="Int64")


def byte_checksum(content: Column) -> Column:
    """Sum of the content's bytes modulo 2^32 - 1; null when empty or absent."""
    return _byte_sum(_bytes(content))


def signature(content, method: str | Column = "MD5", mtime=None) -> Column:
    """Signature of ``content`` (string or binary) by method name.
    ``method`` may be a column (per-file methods, C5)."""
    c = F.col(content) if isinstance(content, str) else content
    b = _bytes(c)
    m = F.lit(method) if isinstance(method, str) else method
    mt = (F.col(mtime) if isinstance(mtime, str) else mtime) if mtime is not None else F.lit(None)
    return (F.when(m == "MD5", _b64_nopad(F.md5(b)))
            .when(m == "SHA-1", _b64_nopad(F.sha1(b)))
            .when(m == "SHA-256", _b64_nopad(F.sha2(b, 256)))
            .when(m == "SHA-512", _b64_nopad(F.sha2(b, 512)))
            # Only contents that are summed go to Python.
            .when(m == "checksum", byte_checksum(F.when(m == "checksum", c)).cast("string"))
            .when(m == "mtime", F.unix_timestamp(mt).cast("string")))


def to_scalar(method, path, sig) -> Column:
    """C8: 'method|path|signature'."""
    return F.concat_ws("|", F.col(method), F.col(path), F.col(sig))


def from_scalar(scalar) -> tuple[Column, Column, Column]:
    s = F.col(scalar) if isinstance(scalar, str) else scalar
    return (F.regexp_extract(s, SCALAR_PATTERN, 1), F.regexp_extract(s, SCALAR_PATTERN, 2),
            F.regexp_extract(s, SCALAR_PATTERN, 3))
