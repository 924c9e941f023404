"""A lineage map that is kept up to date: only new and changed scripts are matched.

The state has a row per script, also for those that write nothing: (path, digest,
names, writes, source, target). `digest` is the hash of the text and `names` that
of the asset lists it was matched with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import WRITE_WORDS
from ..operators.joins import BROADCAST_BYTES, keyed_join, materialize_measured
from ..session import materialize
from .lineage import SOURCE, TARGET, lineage_map

STATE_SCHEMA = "path string, digest string, names string, writes boolean, source string, target string"


def names_digest(files: DataFrame, tables: DataFrame, words=WRITE_WORDS) -> str:
    """Stands for the asset lists, whatever their order, and the writing words."""

    def summed(assets: DataFrame) -> DataFrame:
        rank = F.col("rank") if "rank" in assets.columns else F.lit(0)
        row = F.struct(F.lower("name"), "qualified_name", rank.cast("long"))
        sums = [F.coalesce(F.sum(F.xxhash64(row, F.lit(seed)).cast("decimal(38,0)")), F.lit(0)) for seed in (1, 2)]
        return assets.distinct().agg(F.count(F.lit(1)), *sums)

    parts = [str(tuple(summed(assets).first())) for assets in (files, tables)]
    return "|".join([*parts, *sorted(words)])


def update_map(
    scripts: DataFrame,
    files: DataFrame,
    tables: DataFrame,
    state: DataFrame | None = None,
    *,
    words=WRITE_WORDS,
    wildcards: bool = False,
    bound: int = BROADCAST_BYTES,
) -> DataFrame:
    """The next state: rows of unchanged scripts as they were, the others matched, vanished ones left out.

    `scripts` is (path, text) with a row per script; `state` is what an earlier
    call gave, written or not. Other asset lists or words than those of the state
    match everything anew. The result is a written table.
    """
    spark = scripts.sparkSession
    names = names_digest(files, tables, words) + ("|wildcards" if wildcards else "")
    if state is None:
        state = spark.createDataFrame([], STATE_SCHEMA)
    now = materialize(scripts.select("path", F.sha2("text", 256).alias("digest")), "digests")
    valid = state.where((F.col("names") == names) & F.col("digest").isNotNull())
    kept = valid.join(now, ["path", "digest"], "left_semi")
    fresh, size = materialize_measured(now.join(valid.select("path", "digest"), ["path", "digest"], "left_anti"), "fresh")
    changed = keyed_join(scripts.select("path", "text"), fresh.select("path"), ["path"], "left_semi", ["path"], bound=bound, right_bytes=size)
    found = lineage_map(changed, files, tables, words=words, wildcards=wildcards, bound=bound)
    found = found.withColumn("found", F.lit(True))
    matched = fresh.join(found, "path", "left").select(
        "path", "digest", F.lit(names).alias("names"), F.coalesce("found", F.lit(False)).alias("writes"), SOURCE, TARGET
    )
    return materialize(kept.select(*matched.columns).unionByName(matched), "state")


def mapping_of(state: DataFrame) -> DataFrame:
    """(path, source, target) of the writing scripts, as `lineage_map` gives."""
    return state.where("writes").select("path", SOURCE, TARGET)


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, change): scripts whose row of the map is `added`, `removed` or `changed`."""
    old = mapping_of(before).select("path", F.struct(SOURCE, TARGET).alias("old"))
    new = mapping_of(after).select("path", F.struct(SOURCE, TARGET).alias("new"))
    both = old.join(new, "path", "full")
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select("path", kind.alias("change"))
