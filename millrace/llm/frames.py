"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PREFIX = "__llm_"


def without(docs: DataFrame, names: Sequence[str]) -> DataFrame:
    """`docs` without the columns an operator is about to add: where names
    clash, the operator's own column wins."""
    taken = {n.lower() for n in names}
    return docs.select(*[docs[f"`{c}`"] for c in docs.columns if c.lower() not in taken])


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts; 0 for none."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def blocks_for(total: int, each: int) -> int:
    return max(1, -(-total // each))


def hash_block(blocks: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


def schema_with(docs: DataFrame, ddl: str) -> StructType:
    """The columns of `docs`, and then those of `ddl`."""
    return StructType([*docs.schema.fields, *StructType.fromDDL(ddl).fields])
