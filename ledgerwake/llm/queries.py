"""The operators of this package applied to whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwake.llm import (
    bin_packing,
    domain_mix,
    exact_dedup,
    jaccard_join,
    language,
    periodic_runs,
    secret_scan,
    site_quality,
    sketches,
    substring_dedup,
    token_files,
    url_filter,
    whitening,
)
from ledgerwake.llm.common import read_table
from ledgerwake.llm.ship import ship

Query = Callable[[SparkSession, str], DataFrame]

# The vocabulary whose ids are the tokens of op1, and as ranks and pattern where ids are counted.
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
         ("<|endoftext|>",))

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    @wraps(fn)
    def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = shipped
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


@query
def op1_token_files(spark, sf_dir):
    return token_files.token_table(
        spark, documents(spark, sf_dir), VOCABULARY, end_id=2)


@query
def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.table(documents(spark, sf_dir))


ORACLE_SQL["op2_exact_dedup"] = r"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS t,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
        FROM documents
    )
    SELECT doc_id,
           first_value(doc_id) OVER best AS keep_id,
           count(*) OVER (PARTITION BY norm) AS group_size,
           row_number() OVER best = 1 AS kept,
           sha256(norm) AS text_sha256
    FROM texts
    WINDOW best AS (PARTITION BY norm ORDER BY length(t) DESC, doc_id NULLS LAST)
"""


@query
def op9_language(spark, sf_dir):
    return language.table(documents(spark, sf_dir))


def site(docs: DataFrame) -> dict:
    """Host and path of a document: its source, and its language within the source."""
    return {"host": F.col("source"), "path": F.concat_ws("/", "source", "lang")}


@query
def op10_site_quality(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return site_quality.table(docs, read_table(spark, sf_dir, "labels"), **site(docs))


@query
def op5_secret_scan(spark, sf_dir):
    return secret_scan.scan(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN)


@query
def op8_sketches(spark, sf_dir):
    return sketches.table(documents(spark, sf_dir))


# Share of all tokens that each language is to have.
TARGETS = {"de": 0.2, "en": 0.4, "es": 0.2, "fr": 0.2}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Domains of labelled documents: the language of those that were judged good."""
    good = labels.filter("quality = 1").select("doc_id").distinct()
    return docs.join(good, "doc_id", "left_semi").select("doc_id", F.col("lang").alias("domain"))


@query
def op3_domain_mix(spark, sf_dir):
    docs = documents(spark, sf_dir)
    labelled = labelled_domains(docs, read_table(spark, sf_dir, "labels"))
    return domain_mix.table(docs, labelled, TARGETS, vocabulary=RANKS)


@query
def op6_bin_packing(spark, sf_dir):
    return bin_packing.table(documents(spark, sf_dir), RANKS)


@query
def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.table(documents(spark, sf_dir))


@query
def op11_periodic_runs(spark, sf_dir):
    return periodic_runs.table(documents(spark, sf_dir))


# Verdict, host and beginning of the path.
URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


@query
def op12_url_filter(spark, sf_dir):
    return url_filter.table(read_table(spark, sf_dir, "pages"), URL_RULES)


def _rule_sql(value: str) -> str:
    """The rule that decides, longest first, as a CASE over ``host`` and ``path``."""
    ranked = sorted(URL_RULES, key=lambda r: (-len(str(r)), str(r)))
    return "CASE " + " ".join(
        f"WHEN starts_with(path, '{r.path}') AND (host = '{r.host}' "
        f"OR ends_with(host, '.{r.host}')) THEN '{str(r) if value == 'rule' else r.verdict}'"
        for r in ranked) + " END"


def _level_sql(k: int) -> str:
    """Probabilities of a gram's last character after its ``k`` last characters before that."""
    kinds = {c: (f"(known.{c} + known.{c}_d * below.{c})", f"(known.{c}_n + known.{c}_d)")
             for c in ("accepted", "rejected")}
    values = ", ".join(f"CASE WHEN {n} > 0 THEN {x} / {n} ELSE below.{c} END AS {c}"
                       for c, (x, n) in kinds.items())
    return f"""level{k} AS (
        SELECT below.gram, {values} FROM level{k - 1} AS below
        JOIN known ON known.suffix = substr(below.gram, {url_filter.ORDER + 1 - k}))"""


# The checksum is the common one: 256 table entries, one for each byte, and a step for each byte
# of the host. Grams, smoothing and calibration are those of the operator.
ORACLE_SQL["op12_url_filter"] = rf"""
    WITH RECURSIVE entries(n, c, round) AS (
        SELECT n, n, 0 FROM range(256) AS t(n)
        UNION ALL
        SELECT n, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, round + 1
        FROM entries WHERE round < 8
    ), urls AS (
        SELECT row_number() OVER () AS rid, page_id,
               translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
        FROM pages
    ), hosts AS (SELECT DISTINCT host, hex(encode(host)) AS code FROM urls),
    sums(host, code, c, place) AS (
        SELECT host, code, 4294967295::BIGINT, 0 FROM hosts
        UNION ALL
        SELECT host, code, xor(e.c, s.c // 256), place + 1
        FROM sums AS s JOIN entries AS e
          ON e.round = 8
         AND e.n = xor(s.c, ('0x' || substr(code, 2 * place + 1, 2))::BIGINT) % 256
        WHERE place < length(code) // 2
    ), unseen AS (
        SELECT host, xor(c, 4294967295) % 4 = 2 AS held FROM sums WHERE place = length(code) // 2
    ), rows AS (
        SELECT urls.*, held, {_rule_sql('rule')} AS rule, {_rule_sql('verdict')} AS decided,
               repeat(chr(1), {url_filter.ORDER}) || host || path || chr(2) AS padded
        FROM urls JOIN unseen USING (host)
    ), pieces AS (
        SELECT rid, length(padded) - {url_filter.ORDER} AS size,
               (decided IS NOT DISTINCT FROM 'allow' AND NOT held)::INT AS accepted,
               (decided IS NOT DISTINCT FROM 'block' AND NOT held)::INT AS rejected,
               unnest([substr(padded, i, {url_filter.ORDER + 1})
                       FOR i IN range(1, length(padded) - {url_filter.ORDER - 1})]) AS gram
        FROM rows
    ), seen AS (
        SELECT gram, sum(accepted) AS accepted, sum(rejected) AS rejected FROM pieces GROUP BY gram
    ), counts AS (
        SELECT substr(gram, {url_filter.ORDER + 1} - k) AS suffix, sum(accepted) AS accepted,
               sum(rejected) AS rejected
        FROM seen, range({url_filter.ORDER + 1}) AS t(k) GROUP BY suffix
    ), contexts AS (
        SELECT left(suffix, length(suffix) - 1) AS context, count(*) AS symbols,
               sum(accepted) AS accepted_n, count(*) FILTER (accepted > 0) AS accepted_d,
               sum(rejected) AS rejected_n, count(*) FILTER (rejected > 0) AS rejected_d
        FROM counts GROUP BY context
    ), known AS (
        SELECT * FROM counts JOIN contexts ON context = left(suffix, length(suffix) - 1)
    ), below0 AS (
        SELECT gram, 1 / symbols AS accepted, 1 / symbols AS rejected
        FROM seen JOIN contexts ON context = ''
    ), {_level_sql(0).replace("level-1", "below0")},
    {", ".join(_level_sql(k) for k in range(1, url_filter.ORDER + 1))},
    scores AS (
        SELECT rid, sum(ln(p.accepted) - ln(p.rejected)) / any_value(size) AS score
        FROM pieces JOIN level{url_filter.ORDER} AS p USING (gram) GROUP BY rid
    ), judged AS (
        SELECT *, floor(score * {url_filter.STEPS}) AS step FROM rows JOIN scores USING (rid)
    ), labelled AS (
        SELECT step, decided = 'allow' AS good FROM judged WHERE held AND decided IS NOT NULL
    ), rated AS (
        SELECT step,
               (SELECT count(*) FROM labelled AS l WHERE good AND l.step >= s.step)
                   / (SELECT nullif(count(*), 0) FROM labelled WHERE good)
             + (SELECT count(*) FROM labelled AS l WHERE NOT good AND l.step < s.step)
                   / (SELECT nullif(count(*), 0) FROM labelled WHERE NOT good) AS rate
        FROM (SELECT DISTINCT step FROM labelled) AS s
    ), least AS (
        SELECT coalesce((SELECT step FROM rated WHERE rate IS NOT NULL
                         ORDER BY rate DESC, abs(step), step LIMIT 1), 0) AS step,
               (SELECT count(DISTINCT decided) FROM rows WHERE NOT held) = 2 AS learned
    )
    SELECT page_id, host, path, rule,
           coalesce(decided, CASE WHEN host || path <> '' AND (NOT learned OR j.step >= least.step)
                                  THEN 'allow' ELSE 'block' END) AS verdict,
           round(score, 6) AS score
    FROM judged AS j, least
"""


@query
def op13_whitening(spark, sf_dir):
    return whitening.table(read_table(spark, sf_dir, "embeddings"))


@query
def op4_substring_dedup(spark, sf_dir):
    return substring_dedup.table(documents(spark, sf_dir))


ORACLE_SQL["op4_substring_dedup"] = r"""
    WITH texts AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents
    ), starts AS (
        SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i
        FROM texts WHERE len(words) >= 35
    ), windows AS (
        SELECT doc_id, i, sha256(array_to_string(words[i:i + 34], ' ')) AS content FROM starts
    ), covered AS (
        SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS place FROM windows
        WHERE content IN (SELECT content FROM windows GROUP BY content HAVING count(*) > 1)
    ), places AS (
        SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
    ), kept AS (
        SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
        FROM places ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id
    )
    SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256,
           strlen(coalesce(kept, '')) AS kept_bytes
    FROM texts LEFT JOIN kept USING (doc_id)
"""

ORACLE_SQL["op7_jaccard_join"] = r"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS words
        FROM documents
    ), shingles AS (
        SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i
              FROM texts WHERE len(words) > 0)
    ), sizes AS (
        SELECT doc_id, count(shingle) AS n FROM texts LEFT JOIN shingles USING (doc_id)
        GROUP BY doc_id
    ), common AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
        FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        GROUP BY x, y
    ), links AS (
        SELECT x, y FROM common
        JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
        WHERE 100 * common.n >= 90 * (a.n + b.n - common.n)
    ), both_ways AS (
        SELECT x, y FROM links UNION ALL SELECT y, x FROM links
    ), reached(doc_id, other) AS (
        SELECT doc_id, doc_id FROM sizes
        UNION
        SELECT reached.doc_id, y FROM reached JOIN both_ways ON x = other
    )
    SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id,
           count(*) AS component_size
    FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id
"""
