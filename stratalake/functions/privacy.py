from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pseudonymize(key: Column, length: int = 16, salt: str | None = None) -> Column:
    """Leading hex digits of SHA-256 over the key's text; NULL stays NULL.

    Without a salt small integer keys can be enumerated, and 16 digits (64 bits) collide
    with probability of about 2.7 % at a billion keys.
    """
    text = key.cast("string")
    if salt is not None:
        text = F.concat(F.lit(salt), text)
    return F.substring(F.sha2(text, 256), 1, length)
