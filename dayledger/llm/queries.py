"""One query per operator over its whole table, and SQL where SQL can say the same."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayledger.llm import (
    bytebpe,
    crosstok,
    hardneg,
    licenses,
    linededup,
    maxplus,
    minhash,
    packing,
    passages,
    quality,
    topk,
    toxicity,
    urlfilter,
)

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = linededup.remove_boilerplate(_table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "text", "n_chars", "lines_removed")


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_passages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_chars", "passages")


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes are the quality labels of the same numbers: 0 is bad."""
    outcomes = _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad")
    )
    judged = urlfilter.judge_urls(_table(spark, sf_dir, "pages"), outcomes)
    return judged.withColumns({c: F.round(c, 6) for c in ("bad_share", "lower")})


def license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, their number, and whether they decode to the text."""
    docs = _table(spark, sf_dir, "documents")
    encoded = maxplus.encode(docs, PIECE_BPE).withColumn("n_tokens", F.size("ids"))
    back = maxplus.decode(encoded, PIECE_BPE)
    return back.select("doc_id", "ids", "n_tokens", F.md5("text").alias("decoded_md5"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), WORD_BPE)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(_table(spark, sf_dir, "documents"), PIECE_BPE)
    return judged.select("row.doc_id", *(c for c in judged.columns if c != "row"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes they decode to, as digests."""
    docs = _table(spark, sf_dir, "documents")
    encoded = bytebpe.encode(docs, BYTE_RANKS, public_tokenizers.PATTERN, keep=["doc_id"])
    return bytebpe.decode(encoded, BYTE_RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the id is divisible by 7 the label is the next one."""
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(vectors.withColumn("label", label))


def cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of tokens, groups and links of every text, and the groups as a digest."""
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    docs = _table(spark, sf_dir, "documents")
    aligned = crosstok.align(docs, BYTE_BPE, PIECE_BPE, [*counts, "groups"], keep=["doc_id"], brief=True)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    weighted = crosstok.link_weights(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return weighted.select("doc_id", *counts, "n_best", "count_sum", "groups_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline`` over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_near_duplicates": near_duplicates,
    "op2_line_dedup": line_dedup,
    "op3_repeated_passages": repeated_passages,
    "op4_toxicity": toxic_documents,
    "op5_exact_top_k": exact_top_k,
    "op6_url_filters": url_filters,
    "op7_license_scans": license_scans,
    "op8_sentencepiece": sentencepiece_round_trip,
    "op9_best_fit_packing": best_fit_packing,
    "op10_quality_rules": quality_rules,
    "op11_byte_bpe": byte_bpe,
    "op12_hard_negatives": hard_negatives,
    "op13_cross_tokenizer": cross_tokenizer,
    "pipeline": pipeline,
}

_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


def _url_rule(what: int) -> str:
    cases = []
    for rule, verdict in sorted(urlfilter.RULES, key=lambda r: (-len(r[0]), r[0])):
        name, _, start = rule.partition("/")
        fits = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{start}')"
        cases.append(f"WHEN {fits} THEN '{(rule, verdict)[what]}'")
    return f"CASE {' '.join(cases)} END"


def _shrunk(name: str, groups: str, prior: str, on: str) -> str:
    """CTEs of one level: ``name`` has the groups with m0, s0, mean and weight."""
    low, most = urlfilter.LEAST_STRENGTH, urlfilter.MOST_STRENGTH
    return f"""
    {name}_j AS (SELECT * FROM {groups} JOIN {prior} USING ({on})),
    {name}_s AS (SELECT {on}, sum(n * power(bad / n - m0, 2)) / sum(n) - sum(m0 * (1 - m0)) / sum(n) AS v,
                        max(m0 * (1 - m0)) AS c FROM {name}_j WHERE n > 0 GROUP BY {on}),
    {name} AS (SELECT *, (bad + s0 * m0) / (n + s0) AS mean, n + s0 AS weight FROM (
        SELECT j.*, coalesce(least(greatest(CASE WHEN v > 0 THEN c / v - 1 ELSE {most} END, {low}), {most}), {low}) AS s0
        FROM {name}_j j LEFT JOIN {name}_s s USING ({on}))),"""


_IDS = "CASE " + " ".join(
    f"WHEN regexp_full_match(s, '{pattern}') THEN '{name}'" for name, pattern in licenses.SENTENCES
) + " END"
_SPEAKS = " OR ".join(f"contains({{0}}, '{cue}')" for cue in (*licenses.CUES, "any later version"))
_WRITTEN = [("".join(f"<{i}>" for i in ids.split()), licence) for licence, ids in licenses.RULES]

ORACLES = {
    "op1_near_duplicates": f"""
    WITH RECURSIVE t AS (SELECT text, min(doc_id) AS id FROM documents WHERE text IS NOT NULL GROUP BY text),
    w AS (SELECT id, {_WORDS} AS w FROM t),
    i AS (SELECT id, w, unnest(range(1, greatest(len(w) - {minhash.RUN - 1}, 1) + 1)) AS i FROM w WHERE len(w) > 0),
    c AS (SELECT id, array_to_string(w[i:i + {minhash.RUN - 1}], ' ') AS s, count(*) AS c FROM i GROUP BY ALL),
    n AS (SELECT id, sum(c) AS n FROM c GROUP BY id),
    o AS (SELECT a.id AS x, b.id AS y, sum(least(a.c, b.c)) AS o FROM c a JOIN c b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
    l AS (SELECT x, y FROM o JOIN n nx ON nx.id = x JOIN n ny ON ny.id = y WHERE o >= {minhash.SIMILARITY} * (nx.n + ny.n - o)),
    e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
    r AS (SELECT id, id AS label FROM t UNION SELECT e.y, r.label FROM r JOIN e ON e.x = r.id),
    k AS (SELECT id, min(label) AS class_id FROM r GROUP BY id)
    SELECT doc_id, coalesce(class_id, doc_id) AS class_id, coalesce(class_id = doc_id, true) AS stays
    FROM documents d LEFT JOIN t USING (text) LEFT JOIN k ON k.id = t.id""",
    "op5_exact_top_k": f"""
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id,
                 CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= {topk.K}""",
    "op12_hard_negatives": """
    WITH v AS (
        SELECT row_number() OVER () AS r, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.r, a.id AS anchor_id, a.label = o.label AS same, o.r AS o, o.id,
                 CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * o.v[i])) AS BIGINT) AS score
          FROM v a JOIN v o ON a.id % 50 = 0 AND a.r <> o.r),
    p AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, id, o) AS k FROM s WHERE same QUALIFY k <= 5),
    n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.r, p.k ORDER BY s.score DESC, s.id, s.o) AS rank
          FROM p JOIN s ON s.r = p.r AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= 3""",
    "op6_url_filters": f"""
    WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
    p AS (SELECT page_id,
                 translate(regexp_extract(coalesce(r, ''), '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(coalesce(r, ''), '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
    k AS (SELECT doc_id AS page_id, max(1 - quality) AS b FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    h AS (SELECT host, count(b) AS n, CAST(coalesce(sum(b), 0) AS DOUBLE) AS bad FROM p LEFT JOIN k USING (page_id) GROUP BY host),
    a AS (SELECT *, string_split(host, '.') AS x FROM h),
    b AS (SELECT *, CASE WHEN len(x) >= 3 AND length(x[-1]) = 2 AND x[-2] IN {urlfilter.SECOND_LEVEL} THEN 2 ELSE 1 END AS k FROM a),
    hosts AS (SELECT host, n, bad, array_to_string(x[greatest(len(x) - k, 1):], '.') AS domain,
                     array_to_string(x[greatest(len(x) - k + 1, 1):], '.') AS suffix FROM b),
    domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
    suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, 1 AS whole FROM domains GROUP BY suffix),
    prior0 AS (SELECT whole, (sum(bad) + 1) / (sum(n) + 2) AS m0 FROM suffixes GROUP BY whole),
    {_shrunk("l1", "suffixes", "prior0", "whole")}
    prior1 AS (SELECT suffix, mean AS m0 FROM l1),
    {_shrunk("l2", "domains", "prior1", "suffix")}
    prior2 AS (SELECT suffix, domain, mean AS m0 FROM l2),
    {_shrunk("l3", "hosts", "prior2", "suffix, domain")}
    z AS (SELECT host, mean, mean - {urlfilter.Z} * sqrt(mean * (1 - mean) / (weight + 1)) AS lower FROM l3)
    SELECT page_id, host, path, {_url_rule(0)} AS rule,
           coalesce({_url_rule(1)}, CASE WHEN lower > {urlfilter.LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
           round(mean, 6) AS bad_share, round(lower, 6) AS lower
    FROM p LEFT JOIN z USING (host)""",
    "op7_license_scans": rf"""
    WITH t AS (SELECT doc_id, row_number() OVER () AS row,
                      CASE WHEN {_SPEAKS.format("lower(text)")} THEN text ELSE '' END AS text FROM documents),
    s AS (SELECT doc_id, row, list_filter(
             list_transform(string_split_regex(text, '\n|[.!?;:](?:\s|$)'),
                            lambda x: trim(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}+]+', ' ', 'g'))),
             lambda x: {_SPEAKS.format("x")}) AS s FROM t),
    i AS (SELECT doc_id, list_filter(list_transform(s, lambda s: {_IDS}), lambda x: x IS NOT NULL) AS sentence_ids FROM s)
    SELECT doc_id, sentence_ids, list_transform(
        regexp_extract_all(array_to_string(list_transform(sentence_ids, lambda x: '<' || x || '>'), ''), '({"|".join(i for i, _ in _WRITTEN)})', 1),
        lambda m: CASE {" ".join(f"WHEN m = '{i}' THEN '{name}'" for i, name in _WRITTEN)} END) AS licences
    FROM i""",
}
