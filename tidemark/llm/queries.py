"""The registered queries of the operators, with production parameters, and their SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import alignment, collocations, language_id, licenses, line_dedup, lm_score, mixing, near_dedup, neighbours, pieces, quality_model, quality_rules, secrets

PIECES_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_group():
    """The tables name no domain: sources are put into four by their number."""
    number = F.coalesce(F.regexp_extract("source", "([0-9]+)$", 1), F.lit(""))
    return F.when(number != "", F.concat(F.lit("d"), F.expr("try_cast(regexp_extract(source, '([0-9]+)$', 1) AS bigint)") % 4))


def held_out(folds: int):
    """True for the documents kept from learning; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds == 0


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~held_out(5)).select("doc_id", "text", "lang"), sample_rows=3000)
    return language_id.predict(docs, model).select("doc_id", held_out(5).alias("held_out"), "lang_pred", "score")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = quality_model.fit(docs, labels.filter(~held_out(5)), sample_rows=5000)
    judged = quality_model.judge(docs.select("doc_id", "text"), model)
    return judged.select("doc_id", held_out(5).alias("held_out"), "expected_grade", "p_acceptable", "p_good", "accepted")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.groups(_table(spark, sf_dir, "documents"), width=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(_table(spark, sf_dir, "documents"), held_out(10))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.choose(
        _table(spark, sf_dir, "documents"), domain=source_group(), budget_percent=50, max_epochs=2, seed=17,
        weights={"domain": {"d0": 3, "d1": 2}, "lang": {"en": 4}},
    )


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), every=20, k=20)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = written(F.filter("found", lambda s: s["kind"] != "novel"))
    return found.select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"), number("hex").alias("n_hex"),
        F.sha2(base, 256).alias("base_sha256"), written(F.col("found")).alias("spans"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_rules.base_failed().alias("base_failed"),
        (~quality_rules.base_failed() & F.col("good")).alias("kept"),
        "posterior", *[f"vote_{k}" for k in quality_rules.RULES],
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_docs=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op10_sentencepiece(spark: SparkSession, sf_dir: str, model: str = PIECES_MODEL) -> DataFrame:
    """Ids of every whole text, as a number and a hash, and whether they decode to the text again."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = pieces.Pieces.load(model)
    both = pieces.decode(pieces.encode(docs, model), model)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    at = F.transform("places", lambda p: p["word"])
    base = F.array_sort(F.array_distinct(F.transform("places", lambda p: p["label"])))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
        F.size("expressions").cast("long").alias("n_expressions"), "terms",
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), least=30, percent=80, top=2000)


def op13_alignment(spark: SparkSession, sf_dir: str, byte_level: str = BYTE_LEVEL, marked: str = PIECES_MODEL) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), alignment.Tokenizers.load(byte_level, marked))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_near_dedup": op3_near_dedup,
    "op4_lm_score": op4_lm_score,
    "op5_mixing": op5_mixing,
    "op6_nearest": op6_nearest,
    "op7_secrets": op7_secrets,
    "op8_quality_rules": op8_quality_rules,
    "op9_line_dedup": op9_line_dedup,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_licenses": op11_licenses,
    "op12_collocations": op12_collocations,
    "op13_alignment": op13_alignment,
}

def _shared_sql(level: str, above: list[str], weight: str, parent: str) -> str:
    """One level of the budget tree: the common tables f_<level> and b_<level>."""
    path = ", ".join([*above, level])
    within = f"PARTITION BY {', '.join(above)}" if above else ""
    order = f"{within} ORDER BY cap::DOUBLE / w, {level} NULLS FIRST ROWS BETWEEN"
    joined = f"JOIN {parent} p ON {' AND '.join(f'n.{c} IS NOT DISTINCT FROM p.{c}' for c in above)}" if above else f"CROSS JOIN {parent} p"
    return f"""
        n_{level} AS (SELECT {path}, sum(tokens * 2) AS cap, {weight} AS w FROM leaves GROUP BY {path}),
        f_{level} AS (
            SELECT *, cap * sum(w) OVER ({order} CURRENT ROW AND UNBOUNDED FOLLOWING)
                <= w * (budget - coalesce(sum(cap) OVER ({order} UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
            FROM (SELECT n.*, p.budget FROM n_{level} n {joined})
        ),
        b_{level} AS (
            SELECT {path}, CASE WHEN is_full THEN cap ELSE
                (w * (budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({within}), 0)))
                // sum(CASE WHEN NOT is_full THEN w END) OVER ({within}) END AS budget
            FROM f_{level}
        )"""


_NUMBER = "regexp_extract(source, '([0-9]+)$', 1)"

ORACLES: dict[str, str] = {
    "op5_mixing": rf"""
        WITH d AS (
            SELECT doc_id, CASE WHEN {_NUMBER} <> '' THEN 'd' || (CAST({_NUMBER} AS BIGINT) % 4) END AS domain, lang, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
            FROM documents
        ),
        leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
        root AS (SELECT sum(tokens) * 50 // 100 AS budget FROM leaves),
        {_shared_sql("domain", [], "CASE domain WHEN 'd0' THEN 3 WHEN 'd1' THEN 2 ELSE 1 END", "root")},
        {_shared_sql("lang", ["domain"], "CASE lang WHEN 'en' THEN 4 ELSE 1 END", "b_domain")},
        {_shared_sql("source", ["domain", "lang"], "1", "b_lang")},
        placed AS (
            SELECT d.*, b.budget // l.tokens AS whole, b.budget % l.tokens AS rest,
                   md5('17:' || (b.budget // l.tokens) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place
            FROM d
            JOIN leaves l ON d.domain IS NOT DISTINCT FROM l.domain AND d.lang IS NOT DISTINCT FROM l.lang AND d.source IS NOT DISTINCT FROM l.source
            JOIN b_source b ON d.domain IS NOT DISTINCT FROM b.domain AND d.lang IS NOT DISTINCT FROM b.lang AND d.source IS NOT DISTINCT FROM b.source
        ),
        summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id) AS upto FROM placed),
        chosen AS (
            SELECT doc_id, domain, lang, source, n_tokens,
                   CAST(whole + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END AS BIGINT) AS copies
            FROM summed
        )
        SELECT * FROM chosen WHERE copies > 0
    """,
    "op9_line_dedup": """
        WITH parts AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
        ), lines AS (
            SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM parts
        ), keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
        ), frequent AS (
            SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
        ), marked AS (
            SELECT k.*, f.key IS NOT NULL AS gone FROM keyed k LEFT JOIN frequent f ON k.key = f.key
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id
    """,
    "op12_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), split AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
        ), found AS (
            SELECT lang, m, phrase, count(*) AS f FROM (
                SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i : i + m - 1], ' '))) AS phrase
                FROM split, range(1, 5) AS sizes(m)
            ) GROUP BY ALL
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM found WHERE m = 1 GROUP BY lang
        ), often AS (
            SELECT *, string_split(phrase, ' ') AS w FROM found WHERE m > 1 AND f >= 30
        ), inner_parts AS (
            SELECT lang, part, max(f) AS longer FROM (
                SELECT lang, f, unnest(list_transform(range(1, m - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS part
                FROM often, range(2, 4) AS sizes(k) WHERE k < m
            ) GROUP BY ALL
        ), candidates AS (
            SELECT o.* FROM often o LEFT JOIN inner_parts p ON o.lang = p.lang AND o.phrase = p.part
            WHERE p.longer IS NULL OR 100 * p.longer::HUGEINT < 80 * o.f::HUGEINT
        ), cuts AS (
            SELECT lang, phrase, f, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
            FROM candidates, range(1, 4) AS sizes(k) WHERE k < m
        ), scored AS (
            SELECT c.lang, c.phrase, c.f AS a, x.f AS l, y.f AS r, (2000000 * c.f::HUGEINT // (x.f + y.f))::BIGINT AS score,
                   row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 2000000 * c.f::HUGEINT // (x.f + y.f), k) AS place
            FROM cuts c JOIN found x ON x.lang = c.lang AND x.phrase = c.head JOIN found y ON y.lang = c.lang AND y.phrase = c.tail
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM scored WHERE place = 1
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
    """,
}
