"""The operators over the given tables, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, licences, lines, minhash, neighbours, packing, phrases, prefixes, quality, scoring, simhash, substrings, tokens
from marquee.llm.base import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn=None, sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add(fn) if fn else add


@query
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir))


@query
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf_dir))


@query
def op4_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), content=False)


@query
def op6_line_field_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.rules(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@query
def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))




@query(
    sql="""
WITH line AS (
    SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents
), worded AS (
    SELECT * FROM line WHERE regexp_matches(line, '[^ \t\n\x0B\f\r]')
), boilerplate AS (
    SELECT line FROM worded GROUP BY line HAVING count(DISTINCT source) >= 10 AND count(DISTINCT text) >= 10
), first AS (
    SELECT line, min(ROW(doc_id, pos)) AS place FROM worded SEMI JOIN boilerplate USING (line) GROUP BY line
), marked AS (
    SELECT l.doc_id, l.pos, l.line, regexp_matches(l.line, '[^ \t\n\x0B\f\r]') AS worded, f.line IS NOT NULL AND ROW(l.doc_id, l.pos) <> f.place AS gone
    FROM line l LEFT JOIN first f ON l.line = f.line
)
SELECT doc_id, count(*) FILTER (worded) AS n_lines, count(*) FILTER (gone) AS n_removed,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
)
def op8_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.remove(documents(spark, sf_dir), counts=("n_lines", "n_removed"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query
def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(documents(spark, sf_dir)).select("doc_id", "class_id", "kept")


@query
def op3_relative_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed_words(documents(spark, sf_dir))


@query
def op5_recurrent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_documents(documents(spark, sf_dir))


@query
def op1_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


@query
def op13_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir))


@query(
    sql=r"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, row_number() OVER () AS id, list_filter(regexp_split_to_array(piece, '[ \t]'), lambda w: w <> '') AS words FROM piece
), word AS (
    SELECT lang, id, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM worded
), chain AS (
    SELECT lang, w, lead(w) OVER own AS w2, lead(w, 2) OVER own AS w3 FROM word WINDOW own AS (PARTITION BY id ORDER BY i)
), f AS (
    SELECT lang, [w] AS p, count(*) AS n FROM chain GROUP BY ALL
    UNION ALL SELECT lang, [w, w2], count(*) FROM chain WHERE w2 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, [w, w2, w3], count(*) FROM chain WHERE w3 IS NOT NULL GROUP BY ALL
), candidate AS (
    SELECT lang, p, n FROM f WHERE len(p) > 1 AND n >= 10
), longer AS (
    SELECT lang, p, max(n) AS n FROM (SELECT lang, unnest([p[1:2], p[2:3]]) AS p, n FROM candidate WHERE len(p) = 3) GROUP BY ALL
), cut AS (
    SELECT c.lang, c.p, c.n AS a, k, x.n AS l, y.n AS r, CAST(1000000::HUGEINT * c.n * c.n // (x.n::HUGEINT * y.n) AS BIGINT) AS score
    FROM candidate c CROSS JOIN (VALUES (1), (2)) AS size(k) JOIN f x ON x.lang = c.lang AND x.p = c.p[1:k]
    JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1:len(c.p)]
    LEFT JOIN longer o ON o.lang = c.lang AND o.p = c.p
    WHERE k < len(c.p) AND (o.n IS NULL OR 100 * o.n < 50 * c.n)
), weakest AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), ranked AS (
    SELECT *, array_to_string(p, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank FROM weakest
)
SELECT lang, rank, phrase, a, l, r, CAST(s.n AS BIGINT) AS n, score
FROM ranked JOIN (SELECT lang, sum(n) AS n FROM f WHERE len(p) = 1 GROUP BY lang) s USING (lang) WHERE rank <= 2000
"""
)
def op12_setm_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language."""
    return phrases.mine(documents(spark, sf_dir))


@query(
    sql=r"""
WITH own AS (
    SELECT conv_id AS c, list(ROW(coalesce(role, ''), coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), summed AS (
    SELECT *, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)), lambda s, x:
        list_reduce([xor(s, x), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::BIGINT) ELSE v // 2 END)) AS crc FROM own
), shared AS (
    SELECT c, turns, CAST(xor(crc, 4294967295::BIGINT) % 4 AS INTEGER) AS h FROM summed
), rebuilt AS (
    SELECT s.c, list_concat(coalesce(b.turns, [])[1:h], s.turns[h + 1:len(s.turns)]) AS turns FROM shared s LEFT JOIN own b ON b.c = s.c - s.c % 20
), place AS (
    SELECT c, unnest(range(0, len(turns) + 1)) AS d, turns FROM rebuilt
), node AS (
    SELECT turns[1:d] AS p, d AS depth, min(c) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(turns) = d), '')) AS ends_sha256
    FROM place GROUP BY ALL
), counted AS (
    SELECT n.*, parent.conv_id AS parent_conv_id, (SELECT count(*) FROM node k WHERE k.depth = n.depth + 1 AND k.p[1:n.depth] = n.p) AS n_children,
        (n.n_convs - 1) * (CASE WHEN n.depth = 0 THEN 0 ELSE len(regexp_extract_all(n.p[-1][2], '[^\x20\x09-\x0D]+')) END) AS spared
    FROM node n LEFT JOIN node parent ON parent.depth = n.depth - 1 AND n.p[1:n.depth - 1] = parent.p
)
SELECT any_value(n.conv_id) AS conv_id, n.depth, any_value(n.parent_conv_id) AS parent_conv_id, any_value(n.n_convs) AS n_convs, any_value(n.n_children) AS n_children,
    count(*) FILTER (below.n_children = 0) AS n_leaves, CAST(sum(below.spared) AS BIGINT) AS saved_tokens, any_value(n.ends_sha256) AS ends_sha256
FROM counted n JOIN counted below ON below.depth >= n.depth AND below.p[1:n.depth] = n.p GROUP BY n.p, n.depth
"""
)
def op11_conversation_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of rebuilt conversations."""
    return prefixes.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
