"""One registered query per text operator, with check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def op(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@op("op1_simhash")
def simhash(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.simhash import near_groups

    return near_groups(read(spark, folder, "documents")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@op("op2_packing")
def packing(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.packing import pack_documents

    return pack_documents(read(spark, folder, "documents"), with_ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), "
          r"'[0-9a-z\x{80}-\x{10FFFF}]+')")


@op("op3_decontamination", f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w, least(len(w), 10) AS n FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g FROM
  (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM b WHERE n > 0)),
dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g FROM
  (SELECT *, unnest(range(1, len(w) - n + 2)) AS p
   FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, n, p FROM dw JOIN bw USING (n, g)),
places AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM
  (SELECT doc_id, unnest(range(p, p + n)) AS pos FROM hits) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS joined FROM
  (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits WHERE item_id IS NOT NULL)
  GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN names USING (doc_id)""")
def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.decontam import mark, report

    return report(mark(read(spark, folder, "documents"), read(spark, folder, "benchmark")))


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


@op("op6_line_dedup", f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM split),
keyed AS (SELECT *, translate(trim(line, {_BLANKS}), {_LOWER}) AS key FROM lines),
common AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
           GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT k.*, c.keeper IS NOT NULL AND c.keeper <> k.doc_id AS gone
           FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
    AS kept_sha256
FROM judged GROUP BY doc_id""")
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.linededup import dedup_lines

    return dedup_lines(read(spark, folder, "documents")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2("__kept", 256).alias("kept_sha256"))


@op("op8_exact_dedup", f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), {_LOWER}) AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d""")
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.exactdedup import dedup

    return dedup(spark, f"{folder.rstrip('/')}/documents.parquet").select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@op("op10_pii")
def pii(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.pii import find, report

    return report(find(read(spark, folder, "documents")))


@op("op7_sharding")
def sharding(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.sharding import shard

    return shard(read(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@op("op9_url_filter")
def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.urlfilter import judge

    return judge(read(spark, folder, "pages")).select(
        "page_id", "host", "path", "rule", "verdict")


def _license_sql() -> str:
    """Containment of every template in every window, by plain joins."""
    from tidemill.llm.licenses import CONTAINED, TEMPLATES, shingles, template_words

    rows, sizes = [], []
    for name, text in TEMPLATES.items():
        parts = shingles(template_words(text))
        rows += [f"('{name}', '{p}')" for p in sorted(set(parts))]
        stride = max(1, len(parts) // 2)
        sizes.append(f"('{name}', {len(set(parts))}, {stride}, {len(parts) + stride - 1})")
    return f"""
WITH t(license, part) AS (VALUES {', '.join(rows)}),
s(license, size, stride, width) AS (VALUES {', '.join(sizes)}),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, pos, array_to_string(w[pos + 1:pos + 5], ' ') AS part FROM
  (SELECT *, unnest(range(0, len(w) - 4)) AS pos FROM d WHERE len(w) >= 5)),
m AS (SELECT doc_id, license, part, size,
    unnest(range(greatest(0, (pos - width + stride) // stride), pos // stride + 1)) AS win
  FROM p JOIN t USING (part) JOIN s USING (license)),
c AS (SELECT doc_id, license, max(held) AS containment FROM
  (SELECT doc_id, license, win, count(DISTINCT part) / size::DOUBLE AS held
   FROM m GROUP BY doc_id, license, win, size) GROUP BY doc_id, license HAVING max(held) >= {CONTAINED})
SELECT doc_id, count(license) AS n_licenses,
  coalesce(string_agg(license, ',' ORDER BY license), '') AS licenses,
  coalesce(max(containment), 0.0)::DOUBLE AS containment
FROM d LEFT JOIN c USING (doc_id) GROUP BY doc_id"""


@op("op5_license_scan", _license_sql())
def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.licenses import scan

    return scan(read(spark, folder, "documents")).select(
        "doc_id", F.size("matches").cast("long").alias("n_licenses"),
        F.array_join(F.transform("matches", lambda m: m["license"]), ",").alias("licenses"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["containment"])), F.lit(0.0))
        .alias("containment"))


@op("op4_language_id")
def language_id(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.langid import fit, held_out, predict, sample

    docs = read(spark, folder, "documents")
    return predict(docs, fit(sample(docs)), with_segments=False).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


@op("op11_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.tokencount import count_tokens

    return count_tokens(read(spark, folder, "documents"))


@op("op12_phrases", f"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang,
  unnest(regexp_split_to_array(translate(coalesce(text, ''), {_LOWER}),
    '[.,;:!?\\x{{0A}}-\\x{{0D}}]')) AS piece FROM documents),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^\\x{{20}}\\x{{09}}]+') AS w FROM texts),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM pieces WHERE len(w) > 0),
f AS (SELECT lang, array_to_string(w[p:p + m - 1], ' ') AS phrase, m, count(*) AS a
  FROM places, (SELECT unnest(range(1, 6)) AS m) WHERE p + m - 1 <= len(w)
  GROUP BY lang, phrase, m HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
held AS (SELECT lang, array_to_string(string_split(phrase, ' ')[i:i + k - 1], ' ') AS phrase,
  max(a) AS most FROM f, (SELECT unnest(range(2, 5)) AS k), (SELECT unnest(range(1, 5)) AS i)
  WHERE k < m AND i + k - 1 <= m GROUP BY ALL),
cuts AS (SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, n,
  (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) c
  JOIN f l ON l.lang = c.lang
    AND l.phrase = array_to_string(string_split(c.phrase, ' ')[1:c.k], ' ')
  JOIN f r ON r.lang = c.lang
    AND r.phrase = array_to_string(string_split(c.phrase, ' ')[c.k + 1:c.m], ' ')
  JOIN totals t ON t.lang = c.lang
  LEFT JOIN held h ON h.lang = c.lang AND h.phrase = c.phrase
  WHERE coalesce(most, 0) < c.a),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase
  ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score::BIGINT AS score FROM best QUALIFY rank <= 2000""")
def phrases(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.phrases import top_phrases

    return top_phrases(read(spark, folder, "documents"))


@op("op13_whitening")
def whitening(spark: SparkSession, folder: str) -> DataFrame:
    from tidemill.llm.whitening import whiten

    return whiten(read(spark, folder, "embeddings"))
