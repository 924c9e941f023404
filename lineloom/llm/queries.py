"""Registered queries of the operators, one each: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, conversations, fingerprint, html, language, linededup, lm, merkle, packing, quality, setjoin, suffix, topk
from .common import keyed_mod, table



def op1_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    found = fingerprint.fingerprint_edits(table(spark, d, "documents"))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


def op2_html(spark: SparkSession, d: str) -> DataFrame:
    found = html.main_text(table(spark, d, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_language(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    held_out = keyed_mod("doc_id", 4) == 2
    model = language.learn(docs.where(~held_out), order_by=F.col("doc_id"))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    held_out = keyed_mod("doc_id", 3) == 1
    labels = table(spark, d, "labels").select("doc_id", "quality")
    net = quality.learn(docs, labels.where(~held_out))
    scored = quality.score(docs, net)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_linededup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    found = linededup.dedup_lines(docs)
    return found.select(
        "doc_id",
        "n_lines",
        F.size("dropped").alias("n_dropped"),
        F.length("text").cast("long").alias("kept_chars"),
        F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"),
        F.array_join("dropped", ",").alias("dropped"),
        F.array_join("sources", ",").alias("source_doc_ids"),
    )


def op6_bpe(spark: SparkSession, d: str) -> DataFrame:
    vocabulary = {
        "ranks": public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        "pattern": public_tokenizers.PATTERN,
    }
    coded = bpe.encode(table(spark, d, "documents").select("doc_id", "text"), text="text", **vocabulary).drop("text")
    both = bpe.decode(coded, **vocabulary)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_lm(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    held_out = keyed_mod("doc_id", 5) == 1
    scored, tokens = lm.score_corpus(docs, ~held_out)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def op8_jaccard(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return setjoin.jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


def op9_packing(spark: SparkSession, d: str) -> DataFrame:
    pieces = packing.pack(
        table(spark, d, "documents"),
        tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
        pattern=public_tokenizers.PATTERN,
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op10_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = topk.whole_numbers(table(spark, d, "embeddings"), key="vec_id", vector="embedding")
    found = topk.top_k(rows, rows.where("id % 50 = 0"), k=5)
    return found.withColumnRenamed("id", "vec_id")


def op11_conversations(spark: SparkSession, d: str) -> DataFrame:
    """Conversations with planted damage, by the checksum of each row's key, repaired."""
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    said = lambda column: F.coalesce(F.col(column).cast("string"), F.lit(" "))
    rows = rows.withColumns({"role": said("role"), "text": said("text")})
    harm = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))) % 20
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    damaged = rows.withColumn("harm", harm).select(
        "conv_id",
        "turn",
        F.when(F.col("harm") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("harm") == 0).alias("dropped"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("harm") == 3, 2).otherwise(1))).alias("copy"),
    )
    return conversations.repair(damaged, absent=F.col("dropped"))


def op12_merkle(spark: SparkSession, d: str) -> DataFrame:
    """Proofs of all documents, and what they say of documents of which some were changed."""
    docs = table(spark, d, "documents")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    n_chars = F.when(changed, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(
        docs,
        key="doc_id",
        group="lang",
        leaf=merkle.row_digest("doc_id", "source", "lang", "n_chars", "text"),
        carry={"shown": merkle.row_digest("doc_id", "source", "lang", n_chars, "text")},
    )
    found = found.withColumn("folded_root", merkle.folded("shown"))
    proof = F.sha2(F.array_join(merkle.siblings(), ""), 256)
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_suffix(spark: SparkSession, d: str) -> DataFrame:
    found = suffix.remove_repeats(table(spark, d, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return found.select(
        "doc_id",
        (F.octet_length("kept") + removed).alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


QUERIES = {
    "op1_fingerprint": op1_fingerprint,
    "op2_html": op2_html,
    "op3_language": op3_language,
    "op4_quality": op4_quality,
    "op5_linededup": op5_linededup,
    "op6_bpe": op6_bpe,
    "op7_lm": op7_lm,
    "op8_jaccard": op8_jaccard,
    "op9_packing": op9_packing,
    "op10_topk": op10_topk,
    "op11_conversations": op11_conversations,
    "op12_merkle": op12_merkle,
    "op13_suffix": op13_suffix,
    "pipeline": corpus_pipeline.run,
}
# CRC-32 of a text of ASCII characters.
_CRC32 = """(xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT)),
    lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295))"""
_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || {0}, '-')"
_LEAF = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n_chars}", "text"))

ORACLE: dict[str, str] = {
    # A near line holds one of three segments of the shorter line.
    "op5_linededup": """
WITH line AS (
    SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS raw
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
), item AS (
    SELECT *, trim(raw, ' ') AS line FROM line WHERE regexp_matches(raw, '[^\\x20\\x09-\\x0D]')
), distinct_line AS (
    SELECT line, min((doc_id, pos)) AS first FROM item GROUP BY line
), cut AS (
    SELECT line, first, length(line) AS n, length(line) // 3 AS b, length(line) % 3 AS r FROM distinct_line WHERE length(line) >= 12
), near AS (
    SELECT x.line AS line, y.first AS first, y.line AS other, x.first AS other_first
    FROM cut x JOIN cut y ON x.n BETWEEN y.n AND y.n + 2 AND x.line <> y.line
     AND (starts_with(x.line, left(y.line, y.b)) OR ends_with(x.line, right(y.line, y.b + CAST(y.r > 0 AS INT)))
          OR contains(x.line, substr(y.line, y.b + 1, y.b + CAST(y.r > 1 AS INT))))
    WHERE levenshtein(x.line, y.line) <= 2
), earliest AS (
    SELECT line, min(first) AS first
    FROM (SELECT line, first FROM distinct_line UNION ALL SELECT line, first FROM near UNION ALL SELECT other, other_first FROM near)
    GROUP BY line
), gone AS (
    SELECT i.doc_id, i.pos, e.first FROM item i JOIN earliest e USING (line) WHERE e.first < (i.doc_id, i.pos)
), per_doc AS (
    SELECT doc_id, list(pos ORDER BY pos) AS pos, list_sort(list(DISTINCT first[1])) AS sources FROM gone GROUP BY doc_id
), kept AS (
    SELECT l.doc_id, coalesce(string_agg(l.raw, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL), '') AS text, count(*) AS n
    FROM line l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id
)
SELECT doc_id, CAST(n AS INTEGER) AS n_lines, CAST(coalesce(len(p.pos), 0) AS INTEGER) AS n_dropped, length(text) AS kept_chars,
       sha256(text) AS kept_sha256, coalesce(array_to_string(p.pos, ','), '') AS dropped,
       coalesce(array_to_string(p.sources, ','), '') AS source_doc_ids
FROM kept LEFT JOIN per_doc p USING (doc_id)
""",
    "op8_jaccard": """
WITH RECURSIVE word AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+') AS w
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM word
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id
    JOIN size x ON x.doc_id = a.doc_id JOIN size y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))
), reach AS (
    SELECT doc_id AS node, doc_id AS label FROM documents UNION SELECT link.b, reach.label FROM reach JOIN link ON link.a = reach.node
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, label AS component_id
FROM (SELECT node AS doc_id, min(label) AS label FROM reach GROUP BY node) LEFT JOIN size USING (doc_id)
""",
    "op10_topk": """
WITH sound AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.ints, c.ints), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM sound q JOIN sound c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    # The state of a repaired prefix is its last role: 0 none, 1 system, 2 user, 3 assistant.
    "op11_conversations": f"""
WITH RECURSIVE harmed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_CRC32.format("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS harm
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
           CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE harm WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM harmed WHERE harm <> 0
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth FROM damaged
), judged AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS initial,
           row_number() OVER w AS place, lag(left(role, 1)) OVER w AS before,
           CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' END AS fault
    FROM numbered WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth)
), edge(state, ins, target, letter, price, role) AS (
    -- Steps that take a row, after an insertion if `ins`; an initial of NULL is any.
    SELECT s.state, i.ins, e.target, e.letter, e.price + 2 * i.ins, e.role
    FROM (VALUES (0), (1), (2), (3)) s(state), (VALUES (0), (1)) i(ins), LATERAL (
        SELECT CASE WHEN i.ins = 0 THEN s.state WHEN s.state = 2 THEN 3 ELSE 2 END AS pos
    ) a, LATERAL (
        SELECT CASE WHEN a.pos = 2 THEN 3 ELSE 2 END AS target, 'R' AS letter, 2 AS price, CASE WHEN a.pos = 2 THEN 'assistant' ELSE 'user' END AS role
        UNION ALL SELECT CASE WHEN a.pos = 2 THEN 3 ELSE 2 END, 'K', 0, CASE WHEN a.pos = 2 THEN 'a' ELSE 'u' END
        UNION ALL SELECT 1, 'K', 0, 's' WHERE a.pos = 0
        UNION ALL SELECT s.state, 'D', 3, NULL WHERE i.ins = 0
    ) e
), way(conv_id, place, state, best) AS (
    SELECT conv_id, CAST(0 AS BIGINT), 0, {{'cost': 0::BIGINT, 'audit': '', 'said': []::VARCHAR[]}} FROM (SELECT DISTINCT conv_id FROM judged)
    UNION ALL
    SELECT conv_id, place, target, min(best)
    FROM (
        SELECT w.conv_id, j.place, e.target, {{
            'cost': w.best.cost + e.price + CASE WHEN e.letter <> 'D' AND j.fault = 'truncated' THEN 1 ELSE 0 END,
            'audit': w.best.audit || CASE e.ins WHEN 1 THEN 'I' ELSE '' END || e.letter,
            'said': w.best.said || CASE WHEN e.ins = 0 THEN []::VARCHAR[] WHEN w.state = 2 THEN ['assistant:'] ELSE ['user:'] END
                    || CASE e.letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [j.role || ':' || j.text] ELSE [e.role || ':' || j.text] END
        }} AS best
        FROM way w JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.place = w.place + 1
        JOIN edge e ON e.state = w.state AND (e.letter <> 'K' OR e.role = j.initial)
         AND (e.letter = 'D' OR j.fault IS NULL OR j.fault = 'truncated')
    ) GROUP BY conv_id, place, target
), fact AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE fault = 'truncated') AS truncated,
           count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
), ended AS (
    SELECT w.conv_id, min(CASE w.state WHEN 2 THEN {{'cost': best.cost + 2, 'audit': best.audit || 'I', 'said': best.said || ['assistant:']}} ELSE best END) AS best
    FROM way w JOIN fact f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.place WHERE w.state <> 1 GROUP BY w.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.best.cost, 0) AS cost,
       coalesce(e.best.audit, '') AS audit, sha256(coalesce(array_to_string(e.best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN fact f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
""",
    "op12_merkle": f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, lang, sha256({_LEAF.format(n_chars="n_chars")}) AS leaf,
           CASE WHEN {_CRC32.format("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN sha256({_LEAF.format(n_chars="(n_chars + 1)")})
                ELSE sha256({_LEAF.format(n_chars="n_chars")}) END AS shown,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
    FROM documents
), low(level, lang, pos, node, n) AS (
    SELECT 0, lang, pos, leaf, n FROM doc
    UNION ALL
    SELECT level + 1, lang, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2 FROM low WHERE n > 1 GROUP BY level, lang, pos // 2, n
), sub AS (
    SELECT lang, level AS height, node AS subroot, row_number() OVER (ORDER BY coalesce('=' || lang, '')) - 1 AS pos, count(*) OVER () AS n
    FROM low WHERE n = 1
), high(level, pos, node, n) AS (
    SELECT 0, pos, subroot, n FROM sub
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2 FROM high WHERE n > 1 GROUP BY level, pos // 2, n
), top AS (SELECT level AS height, node AS root FROM high WHERE n = 1
), step AS (
    SELECT d.doc_id, l.level, d.pos >> l.level AS place, l.node
    FROM doc d JOIN low l ON l.lang IS NOT DISTINCT FROM d.lang AND l.n > 1 AND l.pos = xor(d.pos >> l.level, 1)
    UNION ALL
    SELECT d.doc_id, s.height + h.level, s.pos >> h.level, h.node
    FROM doc d JOIN sub s ON s.lang IS NOT DISTINCT FROM d.lang JOIN high h ON h.n > 1 AND h.pos = xor(s.pos >> h.level, 1)
), fold(doc_id, level, height, node) AS (
    SELECT d.doc_id, CAST(0 AS BIGINT), CAST(s.height + t.height AS BIGINT), d.shown FROM doc d JOIN sub s ON s.lang IS NOT DISTINCT FROM d.lang, top t
    UNION ALL
    SELECT f.doc_id, f.level + 1, f.height, sha256(CASE WHEN s.node IS NULL THEN f.node WHEN s.place & 1 = 1 THEN s.node || f.node ELSE f.node || s.node END)
    FROM fold f LEFT JOIN step s ON s.doc_id = f.doc_id AND s.level = f.level WHERE f.level < f.height
), proof AS (SELECT doc_id, string_agg(node, '' ORDER BY level) AS all_nodes FROM step GROUP BY doc_id)
SELECT d.doc_id, d.leaf, s.subroot, t.root, sha256(coalesce(p.all_nodes, '')) AS proof_sha256, f.node AS folded_root, f.node = t.root AS verified
FROM doc d JOIN sub s ON s.lang IS NOT DISTINCT FROM d.lang LEFT JOIN proof p USING (doc_id)
JOIN fold f ON f.doc_id = d.doc_id AND f.level = f.height, top t
""",
    # Bytes as two hex digits each.
    "op13_suffix": """
WITH doc AS (
    SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), part AS (
    SELECT doc_id, row, low, substr(h, 2 * low + 1, 2 * (256 + 49)) AS h, least(256, n - 49 - low) AS n
    FROM (SELECT *, unnest(range(0, n - 49, 256)) AS low FROM doc WHERE n >= 50)
), start AS (
    SELECT doc_id, row, low + pos AS pos, md5_number(substr(h, 2 * pos + 1, 100)) AS s FROM (SELECT *, unnest(range(n)) AS pos FROM part)
), least AS (
    SELECT s, min(coalesce(doc_id, -9223372036854775808)) AS least FROM start GROUP BY s HAVING count(*) > 1
), hit AS (
    SELECT row, pos FROM start JOIN least USING (s) WHERE coalesce(doc_id, -9223372036854775808) > least
), run AS (
    SELECT row, min(pos) AS low, max(pos) + 50 AS high
    FROM (SELECT *, sum(fresh) OVER (PARTITION BY row ORDER BY pos) AS nr
          FROM (SELECT *, CASE WHEN pos > lag(pos, 1, -51) OVER (PARTITION BY row ORDER BY pos) + 50 THEN 1 ELSE 0 END AS fresh FROM hit))
    GROUP BY row, nr
), piece AS (
    SELECT row, high AS low, lead(low) OVER (PARTITION BY row ORDER BY low) AS high FROM run
    UNION ALL SELECT row, 0, min(low) FROM run GROUP BY row
), kept AS (
    SELECT row, string_agg(substr(h, 2 * p.low + 1, 2 * (coalesce(p.high, n) - p.low)), '' ORDER BY p.low) AS h
    FROM piece p JOIN doc USING (row) GROUP BY row
), gone AS (SELECT row, sum(high - low) AS n_removed, count(*) AS n_spans FROM run GROUP BY row)
SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.h, d.h))) AS kept_sha256
FROM doc d LEFT JOIN gone USING (row) LEFT JOIN kept k USING (row)
""",
}
