"""From script text to lineage: which file a script reads, which table it writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.names import is_csv_name, job_key, last_segment, short_name
from ..functions.text import LINE_END, WRITE_WORDS, lines_of, mentions_any
from ..operators.entities import TABLE, FILE, JOB, make_entity
from ..operators.joins import BROADCAST_BYTES, keyed_join, materialize_measured
from ..operators.matching import find_names, least_names, names_held
from ..operators.tree import scripts_of, walk_tree
from ..session import materialize

SOURCE, TARGET = "source", "target"
# A table name counts only with a space after it, a file name always.
SUFFIX = {SOURCE: "", TARGET: " "}


def assets(entities: DataFrame, type_name: str) -> DataFrame:
    """(name, qualified_name) of the entities of one type, name in search form."""
    return entities.where(F.col("type_name") == type_name).select(
        short_name("qualified_name").alias("name"), "qualified_name"
    )


def csv_assets(files: DataFrame, word: str = "csv") -> DataFrame:
    """Keep the files whose last path segment has the word after its first character."""
    return files.where(is_csv_name(last_segment("qualified_name"), word))


def writing_scripts(scripts: DataFrame, words=WRITE_WORDS) -> DataFrame:
    """Paths of the scripts that hold a writing word. Rows may be lines or whole texts."""
    return scripts.where(mentions_any(F.col("text"), words)).select("path").distinct()


def writing_line_counts(lines: DataFrame, words=WRITE_WORDS) -> DataFrame:
    """(path, writing_lines) of the scripts that have such lines, from (path, line) rows."""
    hits = lines.where(mentions_any(F.col("line"), words))
    return hits.groupBy("path").agg(F.count(F.lit(1)).alias("writing_lines"))


def _ordered(asset_list: DataFrame, kind: str) -> DataFrame:
    if "rank" not in asset_list.columns:
        asset_list = asset_list.withColumn("rank", F.lit(0).cast("long"))
    return asset_list.select(
        F.lit(kind).alias("kind"),
        F.concat(F.lower("name"), F.lit(SUFFIX[kind])).alias("pattern"),
        F.col("rank").cast("long").alias("rank"),
        F.lower("name").alias("name"),
        "qualified_name",
    )


def _catalogue(files: DataFrame | None, tables: DataFrame | None) -> tuple[DataFrame, int]:
    """One row per kind and name, its first qualified name, and its place in the order; and the bytes of all.

    `place` makes "first match" a minimum of a number, which the matching
    aggregates in place. It is taken after a global sort and written, so it
    does not change between uses.
    """
    parts = [_ordered(df, kind) for df, kind in ((files, SOURCE), (tables, TARGET)) if df is not None]
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    best = rows.groupBy("kind", "pattern", "name").agg(F.min(F.struct("rank", "qualified_name")).alias("best"))
    ordered = best.select("kind", "pattern", "name", "best.rank", "best.qualified_name").orderBy(
        "rank", "name", "qualified_name", "kind"
    )
    return materialize_measured(ordered.withColumn("place", F.monotonically_increasing_id()), "catalogue")


def _lowered(scripts: DataFrame, wildcards: bool) -> DataFrame:
    # LIKE's % would run over line ends, so wildcards are matched line by line.
    text = F.explode(lines_of(F.col("text"))) if wildcards else F.col("text")
    rest = [c for c in scripts.columns if c != "text"]
    return scripts.select(*rest, text.alias("text")).withColumn("text", F.lower("text"))


def _unit_keys(texts: DataFrame) -> DataFrame:
    return texts.withColumn("unit", F.xxhash64("text"))


def _name_of(rows: DataFrame, catalogue: DataFrame, place: str, name: str, size: int, bound: int) -> DataFrame:
    found = catalogue.select(F.col("place").alias(place), F.col("qualified_name").alias(name))
    return keyed_join(rows, found, [place], "left", ["path"], bound=bound, right_bytes=size).drop(place)


def first_match(
    scripts: DataFrame, asset_list: DataFrame, kind: str, *, wildcards: bool = False, bound: int = BROADCAST_BYTES
) -> DataFrame:
    """(path, source|target): the first asset each script names.

    First means the caller's `rank` if the list has one, then the name, then
    the qualified name. Scripts that name none are left out.
    """
    catalogue, size = _catalogue(asset_list if kind == SOURCE else None, asset_list if kind == TARGET else None)
    texts = _unit_keys(_lowered(scripts, wildcards))
    patterns = catalogue.select("pattern", "kind", "place")
    hits = least_names(texts, ["path", "unit"], "text", patterns, kinds=[kind], wildcards=wildcards, bound=bound)
    # Filtered after grouping: a filter before it would search the texts where they are scanned, before they are dealt.
    first = hits.groupBy("path").agg(F.min(kind).alias("place")).where("place IS NOT NULL")
    return _name_of(first, catalogue, "place", kind, size, bound)


def match_counts(
    lines: DataFrame, asset_list: DataFrame, kind: str, *, wildcards: bool = False, bound: int = BROADCAST_BYTES
) -> DataFrame:
    """(path, name, matching_lines) from numbered lines (path, pos, line)."""
    patterns = asset_list.select(
        F.concat(F.lower("name"), F.lit(SUFFIX[kind])).alias("pattern"), F.lower("name").alias("name")
    )
    patterns = materialize(patterns.distinct(), "patterns")
    texts = lines.select("path", "pos", F.lower("line").alias("line"))
    hits = find_names(texts, ["path", "pos"], "line", patterns, wildcards=wildcards, bound=bound)
    return hits.groupBy("path", "name").agg(F.count_distinct("pos").alias("matching_lines"))


def lineage_map(
    scripts: DataFrame,
    files: DataFrame,
    tables: DataFrame,
    *,
    words=WRITE_WORDS,
    path_like: str | None = None,
    whole_texts: bool = True,
    wildcards: bool = False,
    complete_only: bool = False,
    bound: int = BROADCAST_BYTES,
) -> DataFrame:
    """(path, source, target) of every writing script, NULL where none is named.

    `scripts` is (path, text) with one row per script, or with one row per line
    if `whole_texts` is off (the form for scripts too large for one row).
    `path_like` is a case-sensitive LIKE over the path.
    """
    if path_like is not None:
        scripts = scripts.where(F.col("path").like(path_like))
    writes = mentions_any(F.col("text"), words)
    if whole_texts:
        scripts = scripts.where(writes).withColumn("writes", F.lit(True))
    else:
        scripts = scripts.withColumn("writes", writes)

    catalogue, size = _catalogue(files, tables)
    texts = _unit_keys(_lowered(scripts.select("path", "text", "writes"), wildcards))
    hits = least_names(
        texts,
        ["path", "unit", "writes"],
        "text",
        catalogue.select("pattern", "kind", "place"),
        kinds=[SOURCE, TARGET],
        wildcards=wildcards,
        bound=bound,
    )
    mapped = (
        hits.groupBy("path")
        .agg(
            F.bool_or("writes").alias("writes"),
            F.min(SOURCE).alias("source_place"),
            F.min(TARGET).alias("target_place"),
        )
        .where("writes")
        .drop("writes")
    )
    if complete_only:
        mapped = mapped.where("source_place IS NOT NULL AND target_place IS NOT NULL")
    mapped = _name_of(mapped, catalogue, "source_place", SOURCE, size, bound)
    return _name_of(mapped, catalogue, "target_place", TARGET, size, bound)


def scan_lineage(
    listing: DataFrame, root: str, scripts: DataFrame, files: DataFrame, tables: DataFrame, **options
) -> DataFrame:
    """Lineage map of the scripts a walk through `listing` from `root` reaches.

    `scripts` is (path, text) with the listing's paths; `options` are those of
    `lineage_map`.
    """
    bound = options.get("bound", BROADCAST_BYTES)
    paths = scripts_of(walk_tree(listing, root, bound=bound)).select("path").distinct()
    if options.get("path_like") is not None:
        paths = paths.where(F.col("path").like(options["path_like"]))
    reached = materialize(paths, "reached")
    chosen = keyed_join(scripts, reached, ["path"], "left_semi", ["path"], bound=bound)
    return lineage_map(chosen, files, tables, **options)


def all_matches(
    scripts: DataFrame,
    files: DataFrame,
    tables: DataFrame,
    *,
    words=WRITE_WORDS,
    whole_texts: bool = True,
    wildcards: bool = False,
    bound: int = BROADCAST_BYTES,
) -> DataFrame:
    """(path, kind, qualified_name): every asset each writing script names.

    `scripts` and `whole_texts` are as for `lineage_map`.
    """
    listed = materialize(_both(files, tables).select("kind", "name", "pattern", "qualified_name").distinct(), "listed")
    patterns = materialize(listed.select("kind", "name", "pattern").distinct(), "patterns")
    named = _named(scripts, patterns, words=words, whole_texts=whole_texts, wildcards=wildcards, bound=bound)
    named, listed = named.drop("pattern"), listed.drop("pattern")
    return keyed_join(named, listed, ["kind", "name"], "inner", ["path"], bound=bound).select(
        "path", "kind", "qualified_name"
    )


def _both(files: DataFrame, tables: DataFrame) -> DataFrame:
    return _ordered(files, SOURCE).unionByName(_ordered(tables, TARGET))


def _named(scripts: DataFrame, patterns: DataFrame, *, words, whole_texts: bool, wildcards: bool, bound: int) -> DataFrame:
    """(path, kind, name, pattern): every name each writing script has."""
    searched = scripts.where(mentions_any(F.col("text"), words)) if whole_texts else scripts
    texts = _unit_keys(_lowered(searched.select("path", "text"), wildcards))
    asked = patterns.withColumn("whole", F.col("pattern"))
    hits = find_names(texts, ["path", "unit"], "text", asked, wildcards=wildcards, bound=bound)
    named = hits.select("path", "kind", "name", F.col("whole").alias("pattern")).distinct()
    return named if whole_texts else named.join(writing_scripts(scripts, words), "path", "left_semi")


def evidence(
    scripts: DataFrame, files: DataFrame, tables: DataFrame, *, words=WRITE_WORDS, bound: int = BROADCAST_BYTES
) -> DataFrame:
    """(path, kind, qualified_name, line, column, excerpt): where each writing script first names an asset.

    `scripts` is (path, text) with one row per script. Lines count from 0 as in
    `number_lines`, columns from 1. A short list of names is looked for and placed
    in each text as it is read, without a shuffle. Otherwise the names that a script
    has are found first and gathered per script, so a text is joined once and looked
    through only for those.
    """
    listed = materialize(_both(files, tables).select("kind", "name", "pattern", "qualified_name").distinct(), "listed")
    patterns = materialize(listed.select("kind", "name", "pattern").distinct(), "patterns")
    direct = names_held(patterns, "lowered", bound)
    if direct is not None:
        texts = scripts.where(mentions_any(F.col("text"), words) & F.col("path").isNotNull()).select("path", "text")
        texts = _in_lines(texts).withColumn("names", direct)
    else:
        named = _named(scripts, patterns, words=words, whole_texts=True, wildcards=False, bound=bound)
        names = named.groupBy("path").agg(F.collect_set("pattern").alias("names"))
        names, size = materialize_measured(names, "names-of-scripts")
        texts = keyed_join(scripts.select("path", "text"), names, ["path"], "inner", ["path"], bound=bound, right_bytes=size)
        texts = _in_lines(texts, "names")
    # No name has a line end, so its first line is where the text has it first.
    hits = F.transform("names", lambda name: F.struct(name.alias("pattern"), F.instr("lowered", name).alias("at")))
    found = texts.select("path", "lines", "lowered", F.explode(hits).alias("hit"))
    before = F.substring("lowered", F.lit(1), F.col("hit.at") - 1)
    # Bytes are known without counting characters.
    line = F.octet_length(before) - F.octet_length(F.replace(before, F.lit("\n")))
    found = found.select(
        "path",
        "hit.pattern",
        line.alias("line"),
        (F.length(F.substring_index(before, "\n", -1)) + 1).alias("column"),
        F.get("lines", line).alias("excerpt"),
    )
    return keyed_join(found, listed.drop("name"), ["pattern"], "inner", ["path"], bound=bound).select(
        "path", "kind", "qualified_name", "line", "column", "excerpt"
    )


def _in_lines(texts: DataFrame, *others: str) -> DataFrame:
    """(path, others, lines, lowered): the lines of a text, and the text in lower case with one kind of line end."""
    texts = texts.withColumn("text", F.regexp_replace("text", LINE_END, "\n"))
    return texts.select("path", *others, F.split("text", "\n", -1).alias("lines"), F.lower("text").alias("lowered"))


def resolve_processes(
    mapping: DataFrame, entities: DataFrame, *, source_type: str = FILE, target_type: str = TABLE
) -> DataFrame:
    """Mapping rows whose source and target both are entities, with their guids."""
    complete = mapping.where("source IS NOT NULL AND target IS NOT NULL")
    known = entities.select("type_name", "qualified_name", "guid")
    sources = known.where(F.col("type_name") == source_type).select(
        F.col("qualified_name").alias("source"), F.col("guid").alias("source_guid")
    )
    targets = known.where(F.col("type_name") == target_type).select(
        F.col("qualified_name").alias("target"), F.col("guid").alias("target_guid")
    )
    return complete.join(sources, "source").join(targets, "target")


def unresolved_processes(
    mapping: DataFrame, entities: DataFrame, *, source_type: str = FILE, target_type: str = TABLE
) -> DataFrame:
    """Complete mapping rows that `resolve_processes` leaves out, and which ends are entities."""
    complete = mapping.where("source IS NOT NULL AND target IS NOT NULL")

    def known(kind: str, key: str) -> DataFrame:
        found = entities.where(F.col("type_name") == kind).select(F.col("qualified_name").alias(key))
        return found.distinct().withColumn(f"{key}_known", F.lit(True))

    joined = complete.join(known(source_type, "source"), "source", "left").join(known(target_type, "target"), "target", "left")
    flags = [F.coalesce(f"{k}_known", F.lit(False)).alias(f"{k}_known") for k in ("source", "target")]
    return joined.select("path", "source", "target", *flags).where("NOT (source_known AND target_known)")


def job_entities(
    processes: DataFrame,
    *,
    domain: str,
    scheme: str = "cat",
    type_name: str = JOB,
    source_type: str = FILE,
    target_type: str = TABLE,
) -> DataFrame:
    """One process entity per resolved mapping row, with `inputs` and `outputs`."""
    def reference(kind, key, guid):
        return F.array(
            F.struct(F.lit(kind).alias("type_name"), F.col(key).alias("qualified_name"), F.col(guid).alias("guid"))
        )

    return make_entity(
        processes,
        type_name,
        qualified_name=job_key("path", domain=domain, scheme=scheme),
        name=last_segment("path"),
        attributes={"job_type": F.lit("notebook"), "notebook_path": F.col("path")},
        inputs=reference(source_type, "source", "source_guid"),
        outputs=reference(target_type, "target", "target_guid"),
    )


def lineage_edges(processes: DataFrame, *, domain: str, scheme: str = "cat") -> DataFrame:
    """(src, dst, kind): input to job and job to output, from one pass."""
    job = job_key("path", domain=domain, scheme=scheme)
    edge = lambda src, dst, kind: F.struct(src.alias("src"), dst.alias("dst"), F.lit(kind).alias("kind"))
    both = F.array(edge(F.col("source"), job, "input"), edge(job, F.col("target"), "output"))
    return processes.select(F.explode(both).alias("e")).select("e.src", "e.dst", "e.kind")
