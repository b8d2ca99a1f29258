"""Exact duplicates with a split of the heavy digests.

A digest shared by a large part of the rows would land in one task of a shuffle.
The built-in frequent-items sketch, which is of the Misra-Gries kind (bounded
counters, merged on the map side), names the frequent digests. Their exact
winners and sizes are then counted over all rows; these at most ``HEAVY`` rows
are broadcast, so that heavy rows are decided on the map side. All other digests
go through an ordinary shuffle, where the largest group is bounded by the
sketch's error (about rows / ``TRACKED``) and is still merged map-side first.

Only DataFrame expressions are used.

Results (equal texts are equal SHA-256 digests of their UTF-8 bytes):

* a null text counts as empty; texts are compared whole and unchanged;
* of equal texts the row with the largest id stays; null ids are smaller than all others,
  and a group of null ids only keeps them;
* rows that repeat the id that stays are the same document and stay with it;
* an empty table gives an empty table; internal columns carry names of their own and never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netvigil.llm.common import column_of, kept, read_table

HEAVY = 256
TRACKED = 4096
OWN_ID, DIGEST, KEEP, SIZE = "__nv_id", "__nv_digest", "__nv_keep", "__nv_size"

ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def digests(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(column_of(docs, id_column, "long").alias(OWN_ID),
                       text_digest(column_of(docs, text_column, "string")).alias(DIGEST))


def winners(rows: DataFrame) -> DataFrame:
    """Per digest: the id that stays and the number of rows."""
    return rows.groupBy(DIGEST).agg(F.max(OWN_ID).alias(KEEP), F.count("*").alias(SIZE))


def heavy_winners(rows: DataFrame, heavy: int = HEAVY, tracked: int = TRACKED) -> DataFrame:
    """Exact winners of the digests that the sketch finds frequent: at most ``heavy`` rows."""
    frequent = rows.agg(F.expr(f"approx_top_k(hex({DIGEST}), {heavy}, {tracked})").alias("found")).select(
        F.inline("found")).select(F.unhex("item").alias(DIGEST))
    return kept(winners(rows.join(F.broadcast(frequent), DIGEST, "left_semi")))


def light_winners(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Winners of all other digests that occur more than once."""
    return winners(rows.join(F.broadcast(heavy), DIGEST, "left_anti")).where(F.col(SIZE) > 1)


def decide(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", heavy: int = HEAVY,
           tracked: int = TRACKED) -> DataFrame:
    """One row per row of ``docs``: whether it stays, which row stays for it, and how many are equal."""
    rows = kept(digests(docs, id_column, text_column))
    large = heavy_winners(rows, heavy, tracked)
    on_map_side = rows.join(F.broadcast(large), DIGEST)
    rest = rows.join(F.broadcast(large), DIGEST, "left_anti")
    shuffled = rest.join(light_winners(rows, large), DIGEST, "left").select(
        DIGEST, OWN_ID, F.when(F.col(SIZE).isNull(), F.col(OWN_ID)).otherwise(F.col(KEEP)).alias(KEEP),
        F.coalesce(SIZE, F.lit(1)).alias(SIZE))
    return on_map_side.select(*shuffled.columns).unionAll(shuffled).select(
        F.col(OWN_ID).alias("doc_id"), F.col(KEEP).alias("keep_id"), F.col(SIZE).alias("group_size"),
        F.col(OWN_ID).eqNullSafe(F.col(KEEP)).alias("kept"), F.lower(F.hex(DIGEST)).alias("text_sha256"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", heavy: int = HEAVY,
                tracked: int = TRACKED) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    rows = kept(digests(docs, id_column, text_column))
    large = heavy_winners(rows, heavy, tracked)
    small = light_winners(rows, large)
    own = column_of(docs, id_column, "long")
    marked = docs.select(*[docs[f"`{c}`"] for c in docs.columns], own.alias(OWN_ID),
                         text_digest(column_of(docs, text_column, "string")).alias(DIGEST))
    stays = F.col(SIZE).isNull() | F.col(OWN_ID).eqNullSafe(F.col(KEEP))
    for group in (F.broadcast(large), small):
        marked = marked.join(group, DIGEST, "left").where(stays).drop(KEEP, SIZE)
    return marked.drop(OWN_ID, DIGEST)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(read_table(spark, sf_dir, "documents"))
