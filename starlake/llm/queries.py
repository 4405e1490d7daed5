"""The registered queries: each applies one operator, with production parameters, to its whole table."""
from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, collocations, decontam, embed, packing, pii, quality, secrets, simhash, token_counts, warc, whitening
from .common import scratch_dir, ship_package, table

SLY = "</s>[INST] ok [/INST]"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@register
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line, title and body of all documents; a crossing token goes to the section with most of it."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@register
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to Zstandard WARC archives in the shared folder and read back."""
    pages = table(spark, sf_dir, "pages")
    path = scratch_dir(spark)
    warc.write(pages, path)
    read = warc.read(spark, path, with_payload=False)
    good = read.select("*", F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("bad record: "), "error"))).alias("_"))
    kind = pages.schema["page_id"].dataType
    return good.where("_ is null").select(F.col("headers")["page-id"].cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("headers")["refers-to-page-id"].cast(kind).alias("refers_to"))


@register
def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.95."""
    return embed.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.95)


ORACLE["op3_embedding_near_dedup"] = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_contains([x IS NULL OR NOT isfinite(x) for x in embedding], true)),
pairs AS (
  SELECT a.vec_id AS x, b.vec_id AS y, list_cosine_similarity(a.e, b.e) AS c FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id),
links AS (SELECT x, y FROM pairs WHERE NOT isnan(c) AND c >= 0.95),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT vec_id, (SELECT COUNT(*) FROM links WHERE x = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON x = vec_id
"""


def _spans_sha(spans: Column) -> Column:
    return F.sha2(F.array_join(spans, ","), 256)


def _span_strings(found: str | Column) -> Column:
    return F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))


def _count_kind(found: str, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


@register
def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, each distinct text scanned once through a new ledger."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE]
    return found.select("doc_id", *[_count_kind("found", k) for k in base],
                        _spans_sha(_span_strings(F.filter("found", lambda x: x["kind"].isin(base)))).alias("base_sha256"),
                        F.array_join(_span_strings("found"), ",").alias("spans"))


@register
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and selection of every document, by a model fitted on ``labels``."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, quality.ratings(table(spark, sf_dir, "labels"))))


@register
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: 3-word shingles, links at 3 bits or fewer."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, max_bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@register
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents, and the terms that reveal it by corpus co-occurrence."""
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[_count_kind("found", k) for k in pii.KINDS],
                        _spans_sha(_span_strings(F.filter("found", lambda x: x["kind"].isin(*pii.KINDS)))).alias("base_sha256"),
                        F.array_join(_span_strings("found"), ",").alias("spans"))


@register
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that imitates control strings, through the prefix tree and back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    sly = spark.createDataFrame([(-7, 0, "user", SLY), (-7, 1, "assistant", SLY)], rows.schema)
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    convs, nodes = chat.format_chats(rows.unionByName(sly), *vocabulary)
    read = chat.read_back(convs, nodes, *vocabulary)
    lines = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"), "formatted_chars")


ORACLE["op8_chat_formatting"] = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
       CAST(sum(24 + length(role) + length(regexp_replace(role, '[^\\\\<\\[]', '', 'g'))
                + length(text) + length(regexp_replace(text, '[^\\\\<\\[]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@register
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of all documents that are copies, edited ones included, of a benchmark item."""
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op2_warc"] = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS first_id
  FROM pages),
digits AS (
  SELECT *, [('0x' || substr(hex, CAST(i * 10 + 1 AS INT), 10))::BIGINT for i in range(0, 4)] AS parts FROM hashed)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((parts[CAST(i // 8 + 1 AS INT)] >> CAST(35 - 5 * (i % 8) AS INT)) & 31) + 1 AS INT), 1) for i in range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM digits
"""


@register
def op11_approximate_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth, against all."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@register
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on their 32 first components, whitened."""
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), components=32)
    each = found.select("*", F.posexplode("whitened").alias("_at", "_value"))
    return each.select("vec_id", (F.col("_at") + 1).cast("int").alias("component"), "n", "deviation", F.col("_value").alias("whitened"),
                       F.col("explained")[F.col("_at")].alias("explained"), "identity_error")


@register
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 phrases of two or three words of every language, by association score."""
    return collocations.collocations(table(spark, sf_dir, "documents"), threshold=10, longest=3, top=2000)


ORACLE["op13_phrase_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, unnest(w) AS phrase, 1 AS size FROM split
  UNION ALL SELECT lang, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]), 2 FROM split
  UNION ALL SELECT lang, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]), 3 FROM split),
f AS (SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
inside AS (
  SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS phrase, a FROM candidates WHERE size = 3),
kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = c.lang AND i.phrase = c.phrase AND i.a * 100 >= c.a * 50)),
cuts AS (
  SELECT lang, phrase, a, 1 AS k, w[1] AS x, CASE WHEN size = 2 THEN w[2] ELSE w[2] || ' ' || w[3] END AS y FROM kept
  UNION ALL SELECT lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM kept WHERE size = 3),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, p.f AS l, q.f AS r, CAST((1000000::HUGEINT * c.a * c.a) // (p.f::HUGEINT * q.f) AS BIGINT) AS score
  FROM cuts c JOIN f p ON p.lang = c.lang AND p.phrase = c.x JOIN f q ON q.lang = c.lang AND q.phrase = c.y),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT ranked.lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""
