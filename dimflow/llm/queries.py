"""The queries of the operators, with the rows they must return and, where SQL can say it, that SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimflow.llm import (licenses, lines, minhash, mixing, neighbours, packing, perfect_hash, periodic, pitman_yor, simple8b,
                         toxicity, tries, urls)
from dimflow.llm.common import stored, table
from dimflow.operators.skew import join_skewed
from dimflow.sources.storage import work_dir


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def tokenizer() -> str:
    """The vocabulary file that the queries are asked to use. Operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scored(table(spark, sf_dir, "documents"), fold_of("doc_id", 10) == 0)


def op3_perfect_hash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lower half of the ids counts as history, the rest as a new delivery."""
    docs = table(spark, sf_dir, "documents")
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return perfect_hash.exact_duplicates(docs, F.col("doc_id") < F.lit(((low or 0) + (high or 0)) // 2))


OP3_SQL = """
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM t"""


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer()))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_repeated_runs(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


OP5_SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS n FROM documents),
b AS (SELECT *, row_number() OVER (ORDER BY doc_id, n) AS p, length(line) - length(replace(line, ' ', '')) + 1 AS w
      FROM l WHERE trim(line) <> ''),
c AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY p) AS c FROM b),
pair AS (SELECT a.p AS s, z.p AS e FROM c a JOIN c z ON a.doc_id = z.doc_id AND z.p >= a.p AND z.p < a.p + {lines.MIN_WORDS}
         WHERE z.c - a.c + a.w >= {lines.MIN_WORDS}),
stretch AS (SELECT s, min(e) AS e FROM pair GROUP BY s UNION SELECT max(s), e FROM pair GROUP BY e),
named AS (SELECT s, e, string_agg(line, chr(10) ORDER BY p) AS name FROM stretch JOIN b ON p BETWEEN s AND e GROUP BY s, e),
later AS (SELECT s, e FROM (SELECT *, min(s) OVER (PARTITION BY name) AS f FROM named) WHERE s > f),
gone AS (SELECT DISTINCT p FROM later JOIN b ON p BETWEEN s AND e),
marked AS (SELECT l.doc_id, l.n, l.line, gone.p IS NOT NULL AS cut
           FROM l LEFT JOIN b ON l.doc_id = b.doc_id AND l.n = b.n LEFT JOIN gone ON gone.p = b.p)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN left_over END AS text,
       CASE WHEN text IS NULL THEN 0 ELSE n_lines END AS n_lines, n_removed
FROM (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT cut), '') AS left_over, count(*) AS n_lines,
             count(*) FILTER (cut) AS n_removed FROM marked GROUP BY doc_id) JOIN documents USING (doc_id)"""


#: Domains of the labels, and the share of tokens each is to have.
DOMAINS = {"good": 0.92, "poor": 0.08}


def domain_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> mixing.Mix:
    """Rates for ``docs`` that keep the good tokens and bring the poor ones to their share."""
    labels = table(spark, sf_dir, "labels")
    domain = F.when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    known = labelled(table(spark, sf_dir, "documents").select("doc_id", "text"), labels.select("doc_id", domain.alias("domain")))
    return mixing.fit(docs, mixing.learn(known, tuple(DOMAINS)), tuple(DOMAINS.values()), keep="good")


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = mixing.rated(docs, domain_mix(spark, docs, sf_dir))
    return rated.select("doc_id", "tokens", *[F.col("posteriors")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)], "rate", "copies")


def op7_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "simple8b")
    simple8b.write_ids(table(spark, sf_dir, "documents"), path, tokenizer(), end=2)

    return simple8b.read_ids(spark, path).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                                                 F.crc32("ids").alias("ids_crc32"))


LABEL_ROWS = 4_000_000


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with their labels. Labels are broadcast up to ``LABEL_ROWS`` rows (some 100 MB), else shuffled."""
    return docs.join(F.broadcast(labels) if labels.limit(LABEL_ROWS + 1).count() <= LABEL_ROWS else labels, "doc_id")


def fold_of(doc_id: str, folds: int):
    return F.crc32(F.col(doc_id).cast("string")) % folds


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold_of("doc_id", 3) != 1)
    lexicon = toxicity.learn(labelled(docs, labels))
    return toxicity.scored(docs, lexicon).select("doc_id", (fold_of("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op9_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


#: The rules the query is asked to use.
URL_RULES = (urls.Rule("allow", "com"), urls.Rule("block", "example.com", "/en/"), urls.Rule("allow", "www.example.com", "/en/"),
             urls.Rule("block", "net", "/es/"), urls.Rule("block", "net", "/fr/"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), urls.UrlFilter(URL_RULES)).drop("hits")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP11_SQL = f"""
WITH rules(verdict, h, p) AS (VALUES {', '.join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)}),
terms(term, weight) AS (VALUES {', '.join(f"('{t}', {w})" for t, w in urls.VOCABULARY.items())}),
u AS (SELECT row_number() OVER () AS nr, page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS low,
             CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT nr, page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
                 regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
ruled AS (SELECT nr, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
          FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY nr),
hits AS (SELECT nr, sum(weight) AS weight, count(*) FILTER (weight >= {urls.REJECT}) AS strict,
                count(*) FILTER (weight < {urls.REJECT}) AS soft
         FROM parts JOIN terms ON regexp_matches(low, '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)') GROUP BY nr)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN weight >= {urls.REJECT} THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(strict, 0) AS n_strict, coalesce(soft, 0) AS n_soft
FROM parts LEFT JOIN ruled USING (nr) LEFT JOIN hits USING (nr)"""


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id, text: in a tenth of the documents the words from some place on repeat with some period, by the id's checksum."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when((h % 10 == 0), F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0))
    g, n, a, p = F.floor(h / 10), F.col("_n"), F.col("_a"), F.col("_p")
    parts = (docs.select("doc_id", "text", g.alias("_g"), words.alias("_words")).withColumn("_n", F.size("_words"))
             .withColumn("_a", F.when(n > 0, F.col("_g") % n).cast("int"))
             .withColumn("_p", (1 + F.floor((n - a) / (3 + F.col("_g") % 8))).cast("int")))
    unit = F.slice("_words", a + 1, p)
    rest = F.slice(F.flatten(F.array_repeat(unit, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.concat_ws(" ", F.slice("_words", F.lit(1), a), rest)
    return parts.select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.without_periods(with_planted_periods(table(spark, sf_dir, "documents")))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("s"), r["period"].alias("q"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    told = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("_r"), "runs", "text")
    return told.select("doc_id", "n_runs", F.col("_r.s").alias("start"), (-F.col("_r.n")).alias("length"), F.col("_r.q").alias("period"),
                       F.expr("(-1000 * _r.n) div _r.q").alias("exponent_milli"),
                       F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


FAMILY, HEAD = 20, 4


def with_shared_beginnings(rows: DataFrame) -> DataFrame:
    """``rows`` of ``tries.steps`` with the first h turns of each conversation replaced by those of its family's first one."""
    h, base = fold_of("conv_id", HEAD), F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = rows.filter((F.col("conv_id") % FAMILY == 0) & (F.col("pos") < HEAD)).withColumnRenamed("conv_id", "_base")
    shared = (rows.select("conv_id").distinct().withColumn("_base", base).join(heads, "_base").filter(F.col("pos") <= h)
              .select(*rows.columns))
    lengths = heads.groupBy("_base").agg(F.count(F.lit(1)).alias("_n"))
    own = join_skewed(rows.filter(F.col("pos") > h).withColumn("_base", base), lengths, ["_base"], "left")
    at = F.col("pos") - h + F.least(h, F.coalesce("_n", F.lit(0)))
    return shared.unionByName(own.withColumn("pos", at).select(*rows.columns))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(tries.steps(table(spark, sf_dir, "conversations")), "trie-steps")
    return tries.prefix_trie(stored(with_shared_beginnings(rows), "trie-rebuilt"), rows.select("conv_id"))


OP13_SQL = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos, coalesce(role, '') AS role,
                  coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
          lambda v, bit: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, pos, role, text FROM c JOIN t ON t.conv_id = c.base AND pos <= h
      UNION ALL SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, role, text FROM r),
b AS (SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
             list(struct_pack(r := role, t := text)) OVER (PARTITION BY conv_id ORDER BY depth) AS beginning FROM d
      UNION ALL SELECT conv_id, 0, 0, [] FROM c),
m AS (SELECT conv_id, depth, words, min(conv_id) OVER (PARTITION BY beginning) AS node FROM b),
n AS (SELECT node AS conv_id, depth, count(*) AS n_convs, max(words) AS words FROM m GROUP BY node, depth),
p AS (SELECT n.*, m.node AS parent_conv_id FROM n LEFT JOIN m ON m.conv_id = n.conv_id AND m.depth = n.depth - 1),
k AS (SELECT p.*, (SELECT count(*) FROM p q WHERE q.parent_conv_id = p.conv_id AND q.depth = p.depth + 1) AS n_children FROM p),
s AS (SELECT m.node AS conv_id, m.depth, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * k.words)::BIGINT AS saved_tokens
      FROM k JOIN m ON m.conv_id = k.conv_id AND m.depth <= k.depth GROUP BY m.node, m.depth),
e AS (SELECT node AS conv_id, depth, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ends
      FROM (SELECT *, max(depth) OVER (PARTITION BY conv_id) AS last FROM m) WHERE depth = last GROUP BY node, depth)
SELECT k.conv_id, k.depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM k JOIN s ON k.conv_id = s.conv_id AND k.depth = s.depth LEFT JOIN e ON k.conv_id = e.conv_id AND k.depth = e.depth"""


QUERIES = [
    Query("op1_minhash_near_dedup", op1_minhash_near_dedup),
    Query("op2_pitman_yor", op2_pitman_yor),
    Query("op3_perfect_hash_dedup", op3_perfect_hash_dedup, OP3_SQL),
    Query("op4_best_fit_packing", op4_best_fit_packing),
    Query("op5_line_dedup", op5_line_dedup, OP5_SQL),
    Query("op6_soft_mixing", op6_soft_mixing),
    Query("op7_simple8b", op7_simple8b),
    Query("op8_toxicity", op8_toxicity),
    Query("op9_collision_counting", op9_collision_counting),
    Query("op10_license_scan", op10_license_scan),
    Query("op11_url_filter", op11_url_filter, OP11_SQL),
    Query("op12_periodic_runs", op12_periodic_runs),
    Query("op13_prefix_trie", op13_prefix_trie, OP13_SQL),
]
