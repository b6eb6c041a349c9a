"""One query per operator of this subpackage, over whole tables."""

from __future__ import annotations

import public_tokenizers

from pedalgrid.llm import (
    decontam,
    exact_dedup,
    lang_id,
    lm_score,
    ngram_jaccard,
    phrases,
    pii,
    quality,
    sentencepiece_fst,
    simhash,
    suffix_dedup,
    token_orc,
    vector_codes,
)
from pedalgrid.llm.common import table
from pedalgrid.session import scratch_path


def op1_language(spark, d):
    return lang_id.classify(table(spark, d, "documents"))


def op2_ngram_jaccard(spark, d):
    return ngram_jaccard.cluster(table(spark, d, "documents"))


def op3_suffix_dedup(spark, d):
    return suffix_dedup.digest(suffix_dedup.strip(table(spark, d, "documents")))


def op4_exact_dedup(spark, d):
    early, late = exact_dedup.halves(table(spark, d, "documents"))
    return exact_dedup.decide(late, early)


def op5_lm_score(spark, d):
    return lm_score.score(table(spark, d, "documents"))


def op6_quality(spark, d):
    return quality.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def op7_decontaminate(spark, d):
    return decontam.leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op8_sentencepiece(spark, d):
    return sentencepiece_fst.round_trip(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_personal_data(spark, d):
    return pii.digest(pii.find(table(spark, d, "documents")))


def op10_token_orc(spark, d):
    path = scratch_path(spark, "tokens")
    token_orc.write_tokens(table(spark, d, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_orc.summary(token_orc.read_tokens(spark, path))


def op11_vector_codes(spark, d):
    return vector_codes.compress(table(spark, d, "embeddings"))


def op12_simhash(spark, d):
    return simhash.cluster(table(spark, d, "documents"))


def op13_phrases(spark, d):
    return phrases.mine(table(spark, d, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language,
        op2_ngram_jaccard,
        op3_suffix_dedup,
        op4_exact_dedup,
        op5_lm_score,
        op6_quality,
        op7_decontaminate,
        op8_sentencepiece,
        op9_personal_data,
        op10_token_orc,
        op11_vector_codes,
        op12_simhash,
        op13_phrases,
    )
}


def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Every part against every entry, round by round."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
            SELECT vec_id, part, arg_min(entry, d * {entries} + entry) AS entry, min(d) AS d
            FROM (SELECT v.vec_id, v.part, b.entry, sum((v.c - b.c) * (v.c - b.c)) AS d FROM v JOIN b{k} b USING (part, pos) GROUP BY ALL)
            GROUP BY vec_id, part)""")
        if k < rounds:
            steps.append(f"""b{k + 1} AS MATERIALIZED (
            SELECT part, entry, pos, coalesce(m.c, b.c) AS c FROM b{k} b LEFT JOIN (
                SELECT part, entry, pos, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS c
                FROM (SELECT v.part, entry, pos, sum(v.c) AS s, count(*) AS n FROM v JOIN a{k} USING (vec_id, part) GROUP BY ALL)) m
            USING (part, entry, pos))""")
    return rf"""
        WITH kept AS (SELECT vec_id, label, embedding AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        v AS MATERIALIZED (SELECT vec_id, (i - 1) // w AS part, (i - 1) % w AS pos, CAST(floor(4096 * CAST(e[i] AS DOUBLE)) AS BIGINT) AS c
            FROM (SELECT vec_id, e, len(e) // {parts} AS w, unnest(range(1, len(e) + 1)) AS i FROM kept)),
        b0 AS MATERIALIZED (SELECT part, entry, pos, c FROM v
            JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}) USING (vec_id)),
        {", ".join(steps)},
        coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b{rounds}) AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id)
    """


_PHRASES = r"""
        WITH pieces AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
        runs AS MATERIALIZED (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces)),
        f1 AS MATERIALIZED (SELECT lang, x, count(*) AS f FROM runs GROUP BY ALL),
        f2 AS MATERIALIZED (SELECT lang, x, y, count(*) AS f FROM runs WHERE y IS NOT NULL GROUP BY ALL),
        f3 AS MATERIALIZED (SELECT lang, x, y, z, count(*) AS a FROM runs WHERE z IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        held AS (SELECT lang, x, y, max(a) AS most FROM (SELECT lang, x, y, a FROM f3 UNION ALL SELECT lang, y, z, a FROM f3) GROUP BY ALL),
        cuts AS (
            SELECT p.lang, p.x || ' ' || p.y AS phrase, 1 AS k, p.f AS a, u.f AS l, v.f AS r
            FROM f2 p JOIN f1 u ON u.lang = p.lang AND u.x = p.x JOIN f1 v ON v.lang = p.lang AND v.x = p.y
                 LEFT JOIN held h ON h.lang = p.lang AND h.x = p.x AND h.y = p.y
            WHERE p.f >= 10 AND (most IS NULL OR 100 * most < 50 * p.f)
            UNION ALL
            SELECT p.lang, p.x || ' ' || p.y || ' ' || p.z, 1, p.a, u.f, v.f
            FROM f3 p JOIN f1 u ON u.lang = p.lang AND u.x = p.x JOIN f2 v ON v.lang = p.lang AND v.x = p.y AND v.y = p.z
            UNION ALL
            SELECT p.lang, p.x || ' ' || p.y || ' ' || p.z, 2, p.a, u.f, v.f
            FROM f3 p JOIN f2 u ON u.lang = p.lang AND u.x = p.x AND u.y = p.y JOIN f1 v ON v.lang = p.lang AND v.x = p.z),
        scored AS (SELECT *, CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
        lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
        SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
        FROM ranked JOIN (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang) USING (lang) WHERE rank <= 2000
    """

#: SQL for the same rows, where SQL can say it.
ORACLE = {
    "op4_exact_dedup": r"""
        WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS s FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, s AS text_sha256
        FROM d WINDOW w AS (PARTITION BY s)
    """,
    "op11_vector_codes": _vector_codes_sql(),
    "op13_phrases": _PHRASES,
}
