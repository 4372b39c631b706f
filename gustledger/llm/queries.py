"""Registered queries of this subpackage, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustledger.llm import bpe, fim, kneser, langid, licenses, linededup, maxent, merkle, mixing, neardup, ngramjoin, tokencounts, vafile
from gustledger.llm.common import crc_part, fresh_path
from gustledger.queries.registry import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, d, "documents"), path, public_tokenizers.PATTERN)


@query("op2_maxent_scores")
def op2_maxent_scores(spark: SparkSession, d: str) -> DataFrame:
    return maxent.score(table(spark, d, "documents"))


@query("op3_mix_sources", r"""
    WITH sized AS (
        SELECT doc_id, source, md5(coalesce(text, '')) AS own, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
    sums AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
    weighted AS (
        SELECT source, source_size, list_extract([3, 1, 2], CAST((ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)) AS weight
        FROM sums),
    -- Sources reach their limit in the order of limit by weight; the level follows from those that have.
    ordered AS (
        SELECT *, CAST(SUM(source_size) OVER o AS BIGINT) AS a, CAST(SUM(weight) OVER () - SUM(weight) OVER o AS BIGINT) AS b,
               2.0::DOUBLE * source_size / weight AS reach, CAST(SUM(source_size) OVER () AS BIGINT) AS total
        FROM weighted WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST)),
    levels AS (
        SELECT (1.5::DOUBLE * total - 2.0::DOUBLE * a) / b AS level, reach, LEAD(reach) OVER (ORDER BY a, b DESC) AS next FROM ordered WHERE b > 0
        UNION ALL
        SELECT 1.5::DOUBLE * MAX(total) / SUM(weight), -1, MIN(reach) FROM ordered),
    final AS (
        SELECT COALESCE((SELECT MIN(level) FROM levels WHERE reach <= level AND (next IS NULL OR next > level)), 0) AS level),
    targets AS (
        SELECT source, source_size, LEAST(2.0::DOUBLE * source_size, level * weight) AS target FROM weighted, final),
    rated AS (
        SELECT s.doc_id, s.size, t.source_size, t.target, s.source, s.own,
               CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
           CAST(size * (floor(rate) + CASE WHEN
               ('0x' || substr(md5(concat_ws(chr(31), 'mix', coalesce(CAST(doc_id AS VARCHAR), chr(30)), coalesce(source, chr(30)), own, '')), 1, 13))::BIGINT::DOUBLE
               / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM rated""")
def op3_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    planned = mixing.plan(table(spark, d, "documents").select("doc_id", "source", "text"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op4_exact_top_k", r"""
    WITH whole AS (
        SELECT vec_id, ROW_NUMBER() OVER () AS r, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, q.r, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)),
    ranked AS (SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INT) AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10""")
def op4_exact_top_k(spark: SparkSession, d: str) -> DataFrame:
    return vafile.top_k(table(spark, d, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op5_line_dedup", r"""
    WITH lines AS (
        SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
    keyed AS (
        SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    bad AS (SELECT key, MAX(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 5),
    marked AS (SELECT k.doc_id, k.pos, k.line, b.key IS NOT NULL AS gone FROM keyed k LEFT JOIN bad b ON k.key = b.key AND k.doc_id <> b.last)
    SELECT doc_id, COUNT(*) AS n_lines, CAST(SUM(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id""")
def op5_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = linededup.dedup_lines(table(spark, d, "documents").select("doc_id", "text"), counts=True)
    kept = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return docs.select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


@query("op6_language_id")
def op6_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.learn(docs.filter(~out))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, d: str) -> DataFrame:
    # A cache of its own for each call: a measured run does all its counting.
    counts = tokencounts.token_counts(
        table(spark, d, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), fresh_path(spark, "token-cache")
    )
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query("op8_ngram_jaccard")
def op8_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return ngramjoin.jaccard_components(table(spark, d, "documents"))


@query("op9_embedding_neardup")
def op9_embedding_neardup(spark: SparkSession, d: str) -> DataFrame:
    return neardup.near_links(table(spark, d, "embeddings"))


@query("op10_kneser_quality")
def op10_kneser_quality(spark: SparkSession, d: str) -> DataFrame:
    return kneser.quality(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op11_fill_in_middle", r"""
    WITH hashed AS (
        SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
               list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), i, 8) AS BIGINT)) AS h
        FROM documents),
    cuts AS (
        SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
               CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                    WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
        FROM hashed),
    parts AS (SELECT *, substr(t, 1, a) AS head, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS tail FROM cuts)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || tail || '<P>' || head || '<M>' || mid
                            ELSE '<P>' || head || '<S>' || tail || '<M>' || mid END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM parts""")
def op11_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    cut = fim.transform(table(spark, d, "documents").select("doc_id", "text"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
        sha(fim.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


@query("op12_license_scan")
def op12_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(table(spark, d, "documents"))


# The CRC-32 of the decimal id, bit by bit, as the database has no function for it.
_CRC = """xor(4294967295, list_reduce(
            [4294967295::BIGINT] || list_transform(list_filter(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda ch: ch <> ''),
                                                   lambda ch: CAST(ascii(ch) AS BIGINT)),
            lambda c, b: list_reduce([xor(c, b)] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _merkle_sql(levels: int = 5, upper: int = 4) -> str:
    """The tree level by level, for sources of up to 16^levels rows and up to 16^upper sources."""
    value = lambda c, t: f"coalesce(strlen({t}) || ':' || {t}, '-')" if c == "text" else f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda t: "sha256(" + " || ".join(value(c, t) for c in merkle.FIELDS) + ")"
    tampered = "CASE WHEN bad THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END"
    ctes = [f"""
    docs AS (
        SELECT *, {_CRC} % 5 = 0 AS bad, coalesce('=' || source, '') AS g FROM documents),
    l0 AS (
        SELECT *, {leaf('text')} AS leaf, {leaf('changed')} AS claim FROM (SELECT *, {tampered} AS changed FROM docs)),
    w0 AS (
        SELECT doc_id, g, leaf, claim AS folded, '' AS proof, leaf AS node,
               ROW_NUMBER() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l0)"""]

    def level(w: str, to: str, group: str) -> str:
        """One level: the nodes of each run, and every row's node, folded node, proof and place above."""
        return f"""
    {to}_nodes AS (SELECT DISTINCT {group} AS g, i, node FROM {w}),
    {to}_runs AS (
        SELECT g, i // 16 AS run, list(node ORDER BY i) AS nodes, MAX(COUNT(*)) OVER (PARTITION BY g) + MAX(i // 16) OVER (PARTITION BY g) > 1 AS more
        FROM {to}_nodes GROUP BY g, i // 16),
    {to} AS (
        SELECT w.* REPLACE (
            CASE WHEN more THEN sha256(array_to_string(nodes, '')) ELSE node END AS node,
            CASE WHEN more THEN sha256(array_to_string(nodes[:i % 16] || [folded] || nodes[i % 16 + 2:], '')) ELSE folded END AS folded,
            CASE WHEN more THEN proof || array_to_string(nodes[:i % 16] || nodes[i % 16 + 2:], '') ELSE proof END AS proof,
            i // 16 AS i)
        FROM {w} w JOIN {to}_runs r ON w.{group} = r.g AND w.i // 16 = r.run)"""

    for k in range(levels):
        ctes.append(level(f"w{k}", f"w{k + 1}", "g"))
    ctes.append(f"""
    u0 AS (SELECT * REPLACE (DENSE_RANK() OVER (ORDER BY g) - 1 AS i), node AS subroot, 0 AS one FROM w{levels})""")
    for k in range(upper):
        ctes.append(level(f"u{k}", f"u{k + 1}", "one"))
    return "WITH " + ",".join(ctes) + f"""
    SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified FROM u{upper}"""


@query("op13_merkle_manifest", _merkle_sql())
def op13_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    tampered = F.when(crc_part(F.col("doc_id"), 5) == 0, F.translate("text", capitals, capitals.lower()))
    found = merkle.manifest(table(spark, d, "documents"), claims={"text": tampered})
    folded = found.select("*", merkle.fold(F.coalesce("claim", "leaf"), F.col("siblings")).alias("folded_root"))
    proof = F.sha2(merkle.proof(F.col("siblings")).cast("binary"), 256)
    return folded.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
