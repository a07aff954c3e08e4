"""The registered queries of the corpus operators, and SQL for those that SQL can express.

Each query applies its operator to the whole of its table, with production parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.llm import (
    boilerplate, codes, contamination, credentials, divergence, jaccard, licence, neighbours, phrases, pieces, pii,
    url_filter, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: Rules of `op7_url_filter`.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_secret_scan(spark, sf):
    return credentials.scan(table(spark, sf, "documents"), ["doc_id"])


@query
def op2_quality_divergence(spark, sf):
    return divergence.judge(table(spark, sf, "documents"), ["doc_id"])


@query
def op3_licence_scan(spark, sf):
    return licence.scan(table(spark, sf, "documents"), ["doc_id"])


@query
def op4_line_spread(spark, sf):
    """The documents that stay, with a digest of their text and the number of lines cut."""
    return boilerplate.remove_boilerplate(table(spark, sf, "documents")).select(
        "doc_id", "n_removed", F.sha2("text", 256).alias("text_sha256"))


@query
def op5_nbest_pieces(spark, sf):
    return pieces.segment(table(spark, sf, "documents"), ["doc_id"])


@query
def op6_warc_normalise(spark, sf):
    return warc.archive_round_trip(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_url_filter(spark, sf):
    return url_filter.judge_urls(table(spark, sf, "pages").select("page_id", "url"), URL_RULES).drop("url")


@query
def op8_jaccard_join(spark, sf):
    """Three-word shingles and 0.9, as the contract has it."""
    return jaccard.near_duplicates(table(spark, sf, "documents"), k=3, percent=90).select(
        "doc_id", "n_shingles", "component_id")


@query
def op9_spaced_seeds(spark, sf):
    return contamination.overlaps(table(spark, sf, "documents"), table(spark, sf, "benchmark")).select(
        "doc_id", "item_id", "n_equal", "of")


@query
def op10_pii_deobfuscation(spark, sf):
    return pii.scan(table(spark, sf, "documents"), ["doc_id"])


@query
def op11_slice_codes(spark, sf):
    """Four parts, 256 entries, four rounds."""
    coded, books = codes.compress(table(spark, sf, "embeddings"))
    return coded.withColumn("codebooks_sha256", F.lit(books.digest()))


@query
def op12_stripe_phrases(spark, sf):
    """Phrases of two to five words that occur 100 times or more, the best 2000 of each language."""
    return phrases.collocations(table(spark, sf, "documents"))


@query
def op13_voronoi_top_k(spark, sf):
    """Every row whose id is divisible by 50, against all rows."""
    return neighbours.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def _code_sql(parts: int = codes.PARTS, entries: int = codes.ENTRIES, rounds: int = codes.ROUNDS) -> str:
    """Every part against every entry, round after round."""
    assign = """near{0} AS MATERIALIZED (
  SELECT part.id, part.part, min(struct_pack(
    gap := list_sum(list_transform(range(1, len(part.v) + 1), lambda i: (part.v[i] - book.v[i]) * (part.v[i] - book.v[i]))),
    entry := book.entry)) AS near
  FROM part JOIN book{0} book ON book.part = part.part GROUP BY part.id, part.part)"""
    mean = """place{1} AS (
  SELECT part.part, near.entry, i, floor(sum(part.v[i]) / count(*))::BIGINT AS x
  FROM part JOIN near{0} ON near{0}.id = part.id AND near{0}.part = part.part, unnest(range(1, len(part.v) + 1)) AS u(i)
  GROUP BY part.part, near.entry, i),
book{1} AS MATERIALIZED (
  SELECT book.part, book.entry, coalesce(new.v, book.v) AS v
  FROM book{0} book LEFT JOIN (SELECT part, entry, list(x ORDER BY i) AS v FROM place{1} GROUP BY part, entry) new
    ON new.part = book.part AND new.entry = book.entry)"""
    steps = ",\n".join(assign.format(r) + ",\n" + mean.format(r, r + 1) for r in range(rounds))
    return f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label,
         list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (
  SELECT id, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS v
  FROM kept, unnest(range({parts})) AS p(part)),
book0 AS (SELECT part, id - 1 AS entry, v FROM part WHERE id <= {entries}),
{steps},
{assign.format(rounds)},
coded AS (
  SELECT id, string_agg(printf('%02x', (near).entry), '' ORDER BY part) AS code, sum((near).gap)::BIGINT AS error
  FROM near{rounds} GROUP BY id),
books AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, i)) AS codebooks_sha256
  FROM (SELECT part, entry, unnest(v) AS x, unnest(range(len(v))) AS i FROM book{rounds}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN kept USING (id), books
"""


def _phrase_sql(at_least: int = phrases.MIN_COUNT, size: int = phrases.MAX_WORDS, most: int = phrases.LIST) -> str:
    cuts = ", ".join(f"""(SELECT struct_pack(score := 1000 * c.a::HUGEINT * n // (l.a::HUGEINT * r.a), k := {k}, l := l.a, r := r.a)
      FROM frequent l, frequent r WHERE {k} < len(c.w) AND l.lang = c.lang AND r.lang = c.lang
        AND l.w = c.w[1:{k}] AND r.w = c.w[{k + 1}:])""" for k in range(1, size))
    return f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
gram AS (
  SELECT lang, unnest(list_transform(range(1, len(w) - size + 2), lambda i: w[i:i + size - 1])) AS w
  FROM words, unnest(range(1, {size + 1})) AS s(size) WHERE len(words.w) >= size),
frequent AS MATERIALIZED (
  SELECT lang, w, count(*) AS a FROM gram GROUP BY lang, w HAVING count(*) >= {at_least}),
inside AS (
  SELECT lang, w[i:i + size - 1] AS w, max(a) AS a
  FROM frequent, unnest(range(1, len(w))) AS s(size), unnest(range(1, len(w) - size + 2)) AS p(i) GROUP BY ALL),
candidate AS (
  SELECT c.* FROM frequent c LEFT JOIN inside ON inside.lang = c.lang AND inside.w = c.w
  WHERE len(c.w) > 1 AND (inside.a IS NULL OR 100 * inside.a < 100 * c.a)),
scored AS (
  SELECT c.lang, array_to_string(c.w, ' ') AS phrase, c.a, n, list_min(list_filter([{cuts}], lambda x: x IS NOT NULL)) AS cut
  FROM candidate c JOIN total ON total.lang = c.lang),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY cut.score DESC, a DESC, encode(phrase)) AS rank FROM scored)
SELECT lang, rank, phrase, a, cut.l AS l, cut.r AS r, n::BIGINT AS n, cut.score::BIGINT AS score
FROM ranked WHERE rank <= {most}
"""


_WHITE = " || ".join(f"chr({ord(c)})" for c in boilerplate.WHITE)

ORACLE = {
    "op11_slice_codes": _code_sql(),
    "op12_stripe_phrases": _phrase_sql(),
    "op13_voronoi_top_k": f"""
WITH vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({neighbours.SCALE} * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pair AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM vec q JOIN vec d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pair)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op4_line_spread": f"""
WITH line AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS place
  FROM documents),
long AS (SELECT *, trim(line, {_WHITE}) AS k FROM line WHERE length(trim(line, {_WHITE})) >= {boilerplate.MIN_CHARS}),
common AS (
  SELECT k, min(struct_pack(doc_id := doc_id, place := place)) AS first
  FROM long GROUP BY k HAVING count(DISTINCT coalesce(source, chr(0))) >= {boilerplate.SITES}),
gone AS (
  SELECT doc_id, place FROM long JOIN common USING (k)
  WHERE struct_pack(doc_id := doc_id, place := place) <> first),
cut AS (
  SELECT line.doc_id, count(gone.place) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY line.place) FILTER (gone.place IS NULL), '') AS text
  FROM line LEFT JOIN gone ON line.doc_id = gone.doc_id AND line.place = gone.place GROUP BY line.doc_id)
SELECT d.doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(cut.text, d.text)) AS text_sha256
FROM documents d LEFT JOIN cut USING (doc_id)
WHERE coalesce(n_removed, 0) = 0 OR trim(cut.text, {_WHITE} || chr(10)) <> ''
""",
    "op6_warc_normalise": f"""
WITH page AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
first AS (
  SELECT payload_digest, max(page_id) AS first FROM page
  WHERE payload_bytes >= {warc.REVISIT_BYTES} GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM page LEFT JOIN first USING (payload_digest)
""",
    "op7_url_filter": f"""
WITH rule(verdict, rule) AS (VALUES {", ".join(map(str, URL_RULES))}),
rules AS (SELECT *, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path FROM rule),
split AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS raw,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*(/[^?#]*)', 1), '') AS path
  FROM pages),
page AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM split),
fit AS (
  SELECT page_id, rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC, length(rule_path) DESC) AS nth
  FROM page JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM page LEFT JOIN (SELECT * FROM fit WHERE nth = 1) USING (page_id)
""",
    "op8_jaccard_join": r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingle AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM word),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS MATERIALIZED (
  SELECT a, b FROM common JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM component LEFT JOIN size USING (doc_id)
""",
}
