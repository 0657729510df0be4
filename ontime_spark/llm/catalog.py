"""The numbered queries over whole tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ontime_spark.llm import (
    bpe, hilbert, html_template, jaccard_trie, language, mixing, pii, radix_dedup, repair, toxicity, vectors, zfast_trie,
)
from ontime_spark.llm.common import held_out, table

SHARDS = 16
HILBERT_BITS = 4
NEIGHBOURS = 20


def vocabulary(path: str | None = None) -> list[bytes]:
    """The entries of a rank file on the driver; by default the public byte-level vocabulary."""
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken")) as lines:
        return bpe.read_ranks(lines.read())


def op1_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal numbers of rows, along a curve over source, language and size."""
    text = F.col("text").cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        "lang",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("").cast("binary"))).alias("text_crc32"),
    )
    dimensions = {
        "c_source": hilbert.by_name(F.col("source"), HILBERT_BITS),
        "c_lang": hilbert.by_name(F.col("lang"), HILBERT_BITS),
        "c_size": hilbert.by_magnitude(F.col("size") / 64, HILBERT_BITS),
    }
    sharded = hilbert.hilbert_shards(docs, dimensions, "doc_id", SHARDS, HILBERT_BITS)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.filter(~held_out(F.col("doc_id"))), key=F.col("doc_id"))
    found = language.predict(docs.select("doc_id", "text"), model, keep_columns=["doc_id"])
    return found.withColumn("held_out", held_out(F.col("doc_id")))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_trie.near_duplicate_groups(table(spark, sf_dir, "documents"), words=3, percent=90)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_decode(
        docs, vocabulary(), public_tokenizers.PATTERN, keep_columns=["doc_id"], digests_only=True
    )


def op5_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest_by_inner_product(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, NEIGHBOURS)


def op6_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.nearest_by_hamming(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, NEIGHBOURS)


def op7_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def _is_kind(kind: str) -> Callable:
    return lambda span: span["kind"] == kind


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_personal_data(docs, pii.train(), keep_columns=["doc_id"])
    base = F.filter("personal", lambda s: s["base"])
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    counts = [F.size(F.filter(base, _is_kind(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written("personal").alias("spans")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~held_out(F.col("doc_id"))))
    scored = toxicity.score(docs.select("doc_id", "text"), model, keep_columns=["doc_id"])
    return scored.withColumn("held_out", held_out(F.col("doc_id")))


def op10_template_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_template.extract(table(spark, sf_dir, "pages"), keep_columns=["page_id", "url"])
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix tree of all conversations, rebuilt so that families share their first turns."""
    return zfast_trie.conversation_tree(table(spark, sf_dir, "conversations")).drop("prefix")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations after damage: their faults, and the cheapest edits that mend them."""
    return repair.audit(repair.damage(table(spark, sf_dir, "conversations")))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the owner of their text; of equal texts the largest id stays."""
    return radix_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_hilbert_sharding, op2_language_id, op3_ngram_jaccard_join, op4_byte_bpe, op5_projected_neighbours,
        op6_hamming_top_k, op7_poisson_mixing, op8_personal_data, op9_toxicity, op10_template_extraction,
        op11_conversation_trie, op12_conversation_repair, op13_exact_dedup,
    )
}


def _hilbert_sql(names: list[str], bits: int, source: str) -> str:
    """Steps of queries, each changing the coordinates once; the last adds the index along the curve."""
    steps, count = [], 0

    def step(columns: dict[str, str]) -> None:
        nonlocal source, count
        changed = ", ".join(f"{v} AS {k}" for k, v in columns.items())
        steps.append(f"h{count} AS (SELECT * REPLACE ({changed}) FROM {source})")
        source, count = f"h{count}", count + 1

    first, last = names[0], names[-1]
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        for name in names:
            if name == first:
                step({first: f"CASE WHEN {first} & {q} <> 0 THEN xor({first}, {q - 1}) ELSE {first} END"})
                continue
            t = f"(xor({first}, {name}) & {q - 1})"
            step({
                first: f"CASE WHEN {name} & {q} <> 0 THEN xor({first}, {q - 1}) ELSE xor({first}, {t}) END",
                name: f"CASE WHEN {name} & {q} <> 0 THEN {name} ELSE xor({name}, {t}) END",
            })
    for before, name in zip(names, names[1:]):
        step({name: f"xor({name}, {before})"})
    turned = "0"
    for level in range(bits - 1, 0, -1):
        turned = f"xor({turned}, CASE WHEN {last} & {1 << level} <> 0 THEN {(1 << level) - 1} ELSE 0 END)"
    step({name: f"xor({name}, {turned})" for name in names})
    index = " + ".join(
        f"((({name} >> {b}) & 1) << {b * len(names) + len(names) - 1 - i})"
        for b in range(bits) for i, name in enumerate(names)
    )
    return ", ".join(steps) + f", indexed AS (SELECT *, {index} AS hilbert FROM {source})"


def _by_name_sql(column: str) -> str:
    return f"(CAST('0x' || substr(md5(coalesce({column}, '')), 1, 8) AS BIGINT) >> {32 - HILBERT_BITS})"


#: The table of crc32 by bytes, and the crc32 of a column of texts of some table: c(text, crc).
_CRC_SQL = """crc_table AS (
    SELECT list(c ORDER BY i) AS crcs FROM (
        SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(i))
), crc AS (
    SELECT k, CAST(xor(list_reduce(list_prepend(4294967295::BIGINT,
            list_transform(range(0, length(k)), lambda i: CAST(ascii(substr(k, i + 1, 1)) AS BIGINT))),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) AS BIGINT) AS crc
    FROM crc_keys, crc_table
)"""

SQL = {
    "op1_hilbert_sharding": f"""
WITH crc_table AS (
    SELECT list(c ORDER BY i) AS crcs FROM (
        SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) t(i))
), sized AS (
    SELECT doc_id, source, lang, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size,
        hex(encode(coalesce(text, ''))) AS h
    FROM documents
), summed AS (
    SELECT doc_id, source, lang, size, CAST(xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, size - 1), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32
    FROM sized, crc_table
), points AS (
    SELECT doc_id, size, text_crc32, {_by_name_sql('source')} AS c_source, {_by_name_sql('lang')} AS c_lang,
        least((length(bin(greatest(size // 64, 1))) - 1) * 2
            + CASE WHEN substr(bin(greatest(size // 64, 1)), 2, 1) = '1' THEN 1 ELSE 0 END, {(1 << HILBERT_BITS) - 1}) AS c_size
    FROM summed
), {_hilbert_sql(['c_source', 'c_lang', 'c_size'], HILBERT_BITS, 'points')}, ranked AS (
    SELECT *, row_number() OVER (ORDER BY hilbert, doc_id % 64, doc_id) - 1 AS r, count(*) OVER () AS n FROM indexed
)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(r * {SHARDS} // n AS INTEGER) AS shard,
    CAST(r - ((r * {SHARDS} // n) * n + {SHARDS - 1}) // {SHARDS} AS BIGINT) AS slot,
    CAST(NULL AS INTEGER) AS grown_shard, CAST(hilbert AS BIGINT) AS hilbert
FROM ranked
""",
    "op3_ngram_jaccard_join": r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3
        THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * i >= 90 * (p.n + q.n - i)
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(y) FROM reach WHERE x = d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
""",
    "op6_hamming_top_k": f"""
WITH codes AS (
    SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS c FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
    SELECT q.vec_id AS query_id, r.vec_id,
        CAST(list_sum(list_transform(range(1, len(q.c) + 1), lambda i: CASE WHEN q.c[i] <> r.c[i] THEN 1 ELSE 0 END)) AS INTEGER) AS distance
    FROM codes q JOIN codes r ON q.vec_id % 20 = 0 AND r.vec_id <> q.vec_id
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank FROM pairs
)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= {NEIGHBOURS}
""",
    "op7_poisson_mixing": """
WITH sizes AS (
    SELECT coalesce(source, '') AS source, count(*) AS n FROM documents GROUP BY ALL
), rates AS (
    SELECT source, sqrt(n) / (SELECT sum(sqrt(n)) FROM sizes) * (SELECT sum(n) FROM sizes) / n AS rate FROM sizes
), masses AS (
    SELECT source, k, exp(k * ln(rate) - rate - lgamma(k + 1)) AS mass
    FROM (SELECT source, rate, unnest(range(0, CAST(floor(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS k FROM rates)
), cdfs AS (
    SELECT source, list(c ORDER BY c) AS cdf
    FROM (SELECT source, sum(mass) OVER (PARTITION BY source ORDER BY k) AS c FROM masses) GROUP BY source
), copies AS (
    SELECT d.*, len(list_filter(cdf, lambda c: c <= CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
        / 4503599627370496.0)) AS n
    FROM documents d JOIN cdfs ON cdfs.source = coalesce(d.source, '')
), repeated AS (
    SELECT * EXCLUDE (n), CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy FROM copies WHERE n > 0
)
SELECT *, CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || copy), 1, 13) AS BIGINT)
    / 4503599627370496.0 AS place
FROM repeated
""",
    "op11_conversation_trie": f"""
WITH ids AS (
    SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL
), crc_keys AS (
    SELECT CAST(conv_id AS VARCHAR) AS k FROM ids
), {_CRC_SQL}, turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
        md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS token
    FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
    SELECT conv_id, token, octet_length(encode(text)) AS size,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, token) AS place
    FROM turns
), heads AS (
    SELECT conv_id, conv_id - conv_id % 5 AS head, crc % 9 AS h FROM ids JOIN crc ON k = CAST(conv_id AS VARCHAR)
), rebuilt AS (
    SELECT i.conv_id, 0 AS part, place, token, size FROM heads i JOIN placed p ON p.conv_id = i.head AND place <= h
    UNION ALL SELECT i.conv_id, 1, place, token, size FROM heads i JOIN placed p ON p.conv_id = i.conv_id AND place > h
), paths AS (
    SELECT i.conv_id, coalesce(list(token ORDER BY part, place) FILTER (token IS NOT NULL), []) AS path,
        coalesce(list(size ORDER BY part, place) FILTER (token IS NOT NULL), []) AS sizes
    FROM ids i LEFT JOIN rebuilt r ON r.conv_id = i.conv_id GROUP BY ALL
), steps AS (
    SELECT conv_id, path, sizes, unnest(range(0, len(path) + 1)) AS depth FROM paths
), nodes AS (
    SELECT list_slice(path, 1, depth) AS prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        any_value(CASE WHEN depth = 0 THEN 0 ELSE sizes[depth] END) AS size,
        string_agg(conv_id, ',' ORDER BY conv_id) FILTER (depth = len(path)) AS ends
    FROM steps GROUP BY prefix, depth
), children AS (
    SELECT list_slice(prefix, 1, depth - 1) AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), above AS (
    SELECT list_slice(prefix, 1, d) AS prefix, (n_convs - 1) * size AS saved, leaf FROM (
        SELECT nodes.*, CASE WHEN children.n IS NULL THEN 1 ELSE 0 END AS leaf, unnest(range(0, depth + 1)) AS d
        FROM nodes LEFT JOIN children USING (prefix))
), sums AS (
    SELECT prefix, CAST(sum(saved) AS BIGINT) AS saved, CAST(sum(leaf) AS BIGINT) AS leaves FROM above GROUP BY prefix
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, s.leaves AS n_leaves,
    s.saved AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN sums s USING (prefix) LEFT JOIN children c USING (prefix)
LEFT JOIN nodes p ON n.depth > 0 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)
""",
    "op12_conversation_repair": f"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
    FROM conversations
), crc_keys AS (SELECT DISTINCT k FROM keyed), {_CRC_SQL}, damaged AS (
    SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
        CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE WHEN crc % 20 = 3 THEN [0, 1] ELSE [0] END) AS again
    FROM keyed JOIN crc USING (k) WHERE crc % 20 <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS pos,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
    FROM damaged
), faulty AS (
    SELECT *, lag(left(role, 1)) OVER c AS before, CASE WHEN body = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
    FROM placed WINDOW c AS (PARTITION BY conv_id ORDER BY pos)
), counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faulty GROUP BY conv_id
), steps(state, initial, target) AS (
    VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), inserts AS (
    SELECT state, state AS target, 0 AS cost, '' AS letters, '' AS left_over FROM (VALUES (0), (1), (2), (3)) t(state)
    UNION ALL SELECT state, target, 3, 'I', CASE initial WHEN 'u' THEN chr(10) || 'user:' ELSE chr(10) || 'assistant:' END
        FROM steps WHERE initial <> 's'
    UNION ALL SELECT state, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:' FROM steps WHERE initial = 'u' AND state < 2
), moves AS (
    SELECT conv_id, pos, state, state AS target, 4 AS cost, 'D' AS letters, '' AS left_over FROM faulty, (VALUES (0), (1), (2), (3)) t(state)
    UNION ALL SELECT conv_id, pos, state, target, CASE WHEN fault IS NULL THEN 0 ELSE 3 END, 'K', chr(10) || role || ':' || text
        FROM faulty JOIN steps ON initial = left(role, 1) WHERE fault IS NULL OR fault = 'truncated'
    UNION ALL SELECT conv_id, pos, state, state, CASE WHEN fault IS NULL THEN 0 ELSE 3 END, 'K', chr(10) || role || ':' || text
        FROM faulty, (VALUES (0), (1), (2), (3)) t(state) WHERE role = '' AND (fault IS NULL OR fault = 'truncated')
    UNION ALL SELECT conv_id, pos, state, target, CASE WHEN fault IS NULL THEN 3 ELSE 6 END, 'R',
            chr(10) || CASE initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text
        FROM faulty JOIN steps ON initial <> 's' WHERE fault IS NULL OR fault = 'truncated'
), plan AS (
    SELECT conv_id, 0 AS pos, i.target AS state, {{'cost': i.cost, 'audit': i.letters, 'text': i.left_over}} AS best
    FROM counts, inserts i WHERE i.state = 0
    UNION ALL
    SELECT p.conv_id, m.pos, i.target, min({{'cost': p.best.cost + m.cost + i.cost, 'audit': p.best.audit || m.letters || i.letters,
        'text': p.best.text || m.left_over || i.left_over}})
    FROM plan p JOIN moves m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.pos = p.pos + 1 AND m.state = p.state
    JOIN inserts i ON i.state = m.target GROUP BY p.conv_id, m.pos, i.target
), ended AS (
    SELECT p.conv_id, min(best) AS best FROM plan p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.pos
    WHERE state IN (0, 3) GROUP BY p.conv_id
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.text, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM i.conv_id
""",
    "op13_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
    row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
    sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
}
