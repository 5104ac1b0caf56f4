"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``function(table)`` under ``name``, where ``table(t)`` reads a table, with its SQL if there is one."""

    def enter(function):
        QUERIES[name] = lambda spark, sf_dir: function(lambda table: _table(spark, sf_dir, table))
        if sql is not None:
            ORACLES[name] = sql
        return function

    return enter


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op2_decontamination",
    f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
     b AS (SELECT item_id, {WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
     bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS k
            FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
     lengths AS (SELECT DISTINCT n FROM bw),
     dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
            FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM d, lengths WHERE len(w) >= n)),
     found AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.k = bw.k AND dw.n = bw.n),
     hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY 1),
     ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
             FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)""",
)
def op2_decontamination(table):
    from .decontaminate import decontamination_report

    return decontamination_report(table("documents"), table("benchmark"))


@query("op3_bpe")
def op3_bpe(table):
    from .bpe import bpe_report

    return bpe_report(table("documents"))


ESCAPED = r"regexp_replace(coalesce({0}, ''), '([<\[\\])', '\1\\', 'g')"


@query(
    "op10_chat",
    f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0 FROM conversations
           UNION ALL SELECT -1, n, r, s, r, s FROM (SELECT unnest([0, 1]) AS n, unnest(['user', 'assistant']) AS r, '</s>[INST] ok [/INST]' AS s))
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(16 + length({ESCAPED.format("role")}) + length({ESCAPED.format("text")})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id""",
)
def op10_chat(table):
    from .chat import chat_report, format_chat, with_sample_turns

    return chat_report(format_chat(with_sample_turns(table("conversations"))))


@query("op1_language")
def op1_language(table):
    from .language import language_report

    return language_report(table("documents"))


@query("op9_quality_rules")
def op9_quality_rules(table):
    from .quality_rules import quality_rules_report

    return quality_rules_report(table("documents"))


@query("op5_quality")
def op5_quality(table):
    from .quality_net import quality_report

    return quality_report(table("documents"), table("labels"))


@query("op6_toxicity")
def op6_toxicity(table):
    from .toxicity import toxicity_report

    return toxicity_report(table("documents"), table("labels"))


@query("op4_near_duplicates")
def op4_near_duplicates(table):
    from .near_dup import near_duplicates

    return near_duplicates(table("documents"))


@query("op7_secrets")
def op7_secrets(table):
    from .secrets import secrets_report

    return secrets_report(table("documents"))


@query("op8_pii")
def op8_pii(table):
    from .pii import pii_report

    return pii_report(table("documents"), key="key of the registered query")


@query("op12_whitening")
def op12_whitening(table):
    from .whitening import whitening_report

    return whitening_report(table("embeddings"))


@query("op11_simhash")
def op11_simhash(table):
    from .simhash import simhash_report

    return simhash_report(table("documents"))


@query(
    "op13_collocations",
    r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
     totals AS (SELECT lang, sum(len(w)) AS n FROM worded GROUP BY 1),
     grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
               FROM (SELECT lang, w, k, unnest(range(1, CAST(len(w) - k + 2 AS BIGINT))) AS i FROM worded, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)),
     f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
     alone AS (SELECT c.* FROM f c WHERE k >= 2 AND NOT EXISTS (
                   SELECT 1 FROM f b WHERE b.lang = c.lang AND b.k > c.k AND 100 * b.f >= 100 * c.f AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
     cuts AS (SELECT lang, phrase, f AS a, cut, array_to_string(w[1:cut], ' ') AS lead, array_to_string(w[cut + 1:], ' ') AS rest
              FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM alone)),
     scored AS (SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, t.n,
                       CAST((CAST(1000 AS HUGEINT) * c.a * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
                FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.lead JOIN f r ON r.lang = c.lang AND r.phrase = c.rest JOIN totals t ON t.lang = c.lang),
     best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) WHERE rank <= 2000""",
)
def op13_collocations(table):
    from .collocations import collocations

    return collocations(table("documents"))
