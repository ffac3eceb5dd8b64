"""The operators as queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import (
    chat,
    collocations,
    divergence,
    langid,
    minhash,
    mixing,
    nbsvm,
    packing,
    pieces,
    quality,
    topk,
    toxicity,
    urls,
)
from tallyline.llm.common import kept, pick, remainder, table

Query = Callable[[SparkSession, str], DataFrame]

#: The conversation of the contract that holds control strings.
CONTROL_TURN = "</s>[INST] ok [/INST]"

#: The rules of the contract (verdict, host, path).
URL_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one more whose texts are control strings."""
    turns = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    added = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TURN).alias("text"),
    )
    return chat.chat_digests(turns.unionByName(added))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    trees = quality.train(documents, table(spark, sf_dir, "labels"))
    return quality.judge(documents, trees)


def _held_out(modulus: int, held: int) -> Column:
    return (remainder("doc_id", modulus) == held).alias("held_out")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(
        documents, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0
    )
    scored = toxicity.score_toxicity(documents, model)
    return scored.select("doc_id", _held_out(5, 0), "score", "predicted")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model_path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_documents(table(spark, sf_dir, "documents"), model_path)


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With 4-word shingles, as the contract of this query says."""
    judged = minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)
    return judged.select("doc_id", "n_shingles", "component_id", "kept")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path)


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.train(documents, remainder("doc_id", 5) != 0)
    judged = langid.identify(documents, model)
    return judged.select("doc_id", _held_out(5, 0), "lang_pred", "score", "rejected")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = nbsvm.train(
        documents, table(spark, sf_dir, "labels"), remainder("doc_id", 3) != 1
    )
    scored = nbsvm.score_quality(documents, model)
    return scored.select("doc_id", _held_out(3, 1), "score", "predicted")


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kept(mixing.measured(table(spark, sf_dir, "documents")), "measured")
    mixed = mixing.mix(rows)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_chat_formatting,
        op2_quality_rules,
        op3_toxicity,
        op4_sentencepiece,
        op5_minhash_dedup,
        op6_best_fit_packing,
        op7_url_filters,
        op8_language_id,
        op9_exact_top_k,
        op10_quality_classifier,
        op11_source_mixing,
        op12_source_divergence,
        op13_phrase_collocations,
    )
}

_WORDS = "|".join(urls.HOST_WORDS)

ORACLE: dict[str, str] = {
    "op1_chat_formatting": rf"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL
            SELECT -1, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '{CONTROL_TURN}'
            FROM range(2) AS r(i)
        ), runs AS (
            SELECT *,
                row_number() OVER w AS place,
                coalesce(lag(role) OVER w <> role, true) AS opens,
                length(regexp_replace(role, '{chat.PLAIN}', '\1\\\2\3', 'g')) AS role_chars,
                length(regexp_replace(text, '{chat.PLAIN}', '\1\\\2\3', 'g')) AS text_chars
            FROM turns
            WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        ), strings AS (
            SELECT conv_id, count(*) AS n_turns,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS lines,
                coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')
                    AS learned,
                sum(text_chars + CASE WHEN opens
                    THEN {len(chat.OPEN + chat.ROLE + chat.CLOSE)} + role_chars
                    ELSE {len(chat.TURN)} END) AS formatted_chars
            FROM runs GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(lines) AS turns_sha256,
            length(learned) AS loss_chars, sha256(learned) AS loss_sha256,
            CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM strings
    """,
    "op7_url_filters": rf"""
        WITH parts AS (
            SELECT page_id,
                coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS raw,
                coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
                row_number() OVER () AS place
            FROM pages
        ), hosts AS (
            SELECT page_id, place, path,
                translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
            FROM parts
        ), rules(verdict, rule_host, rule_path) AS (
            VALUES {", ".join(str(rule) for rule in URL_RULES)}
        ), fits AS (
            SELECT place, verdict, rule_host || rule_path AS rule
            FROM hosts JOIN rules
            ON (host = rule_host OR ends_with(host, '.' || rule_host))
                AND starts_with(path, rule_path)
            QUALIFY row_number() OVER (PARTITION BY place
                ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1
        )
        SELECT page_id, host, path, rule, coalesce(verdict,
            CASE WHEN regexp_matches(host, '(^|[.-])({_WORDS})([.-]|$)')
                THEN 'block' ELSE 'allow' END) AS verdict
        FROM hosts LEFT JOIN fits USING (place)
    """,
    "op9_exact_top_k": """
        WITH usable AS (
            SELECT DISTINCT vec_id,
                list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
                CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(d.v AS DOUBLE[])) AS BIGINT) AS score
            FROM usable q JOIN usable d ON q.vec_id <> d.vec_id
            WHERE q.vec_id % 100 = 0
        )
        SELECT query_id,
            CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
            vec_id, score
        FROM scored
        QUALIFY rank <= 10
    """,
    "op5_minhash_dedup": r"""
        WITH RECURSIVE texts AS (
            SELECT doc_id, list_filter(
                regexp_split_to_array(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[\x20\x09-\x0D]+'),
                lambda w: w <> '') AS words
            FROM documents
        ), sets AS (
            SELECT doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(
                range(1, greatest(len(words) - 3, 1) + 1),
                lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
            FROM texts
        ), elements AS (
            SELECT doc_id, len(shingles) AS size, unnest(shingles) AS shingle FROM sets
        ), links AS (
            SELECT a.doc_id AS one, b.doc_id AS other
            FROM elements a JOIN elements b USING (shingle)
            WHERE a.doc_id <> b.doc_id AND 100 * least(a.size, b.size) >= 80 * greatest(a.size, b.size)
            GROUP BY ALL
            HAVING 100 * count(*) >= 80 * (any_value(a.size) + any_value(b.size) - count(*))
        ), reached AS (
            SELECT doc_id, doc_id AS other FROM sets
            UNION
            SELECT reached.doc_id, links.other FROM reached JOIN links ON reached.other = links.one
        ), components AS (
            SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, component_id,
            doc_id = component_id AS kept
        FROM sets JOIN components USING (doc_id)
    """,
    "op11_source_mixing": rf"""
        WITH RECURSIVE sized AS (
            SELECT doc_id, source,
                CAST(len(regexp_extract_all(coalesce(text, ''), '{mixing.WORD}')) AS BIGINT) AS size,
                CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|'
                    || coalesce(text, '')), 1, 15) AS BIGINT) AS hash
            FROM documents
        ), sizes AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                list_value({", ".join(map(str, mixing.WEIGHTS))})[
                    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight
            FROM sized GROUP BY source
        ), levels AS (
            SELECT *, row_number() OVER w AS turn,
                {mixing.SHARE_PERCENT} * sum(source_size) OVER ()
                    - {100 * mixing.MOST} * coalesce(sum(source_size) OVER (w ROWS BETWEEN
                        UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
                sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN
                    UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sharing
            FROM sizes
            WINDOW w AS (ORDER BY source_size * 1.0 / weight, source NULLS LAST)
        ), judged AS (
            SELECT *, {100 * mixing.MOST} * source_size * sharing <= weight * free AS is_full
            FROM levels
        ), level AS (
            SELECT free, sharing FROM judged WHERE NOT is_full ORDER BY turn LIMIT 1
        ), targets AS (
            SELECT source, source_size,
                CASE WHEN is_full THEN CAST({mixing.MOST} * source_size AS DOUBLE)
                    ELSE CAST(weight * level.free AS DOUBLE)
                        / CAST(100 * level.sharing AS DOUBLE) END AS target,
                CASE WHEN is_full THEN {mixing.MOST} * source_size
                    ELSE weight * level.free // (100 * level.sharing) END AS words,
                CASE WHEN source_size = 0 THEN 0 ELSE words // source_size END AS whole,
                CASE WHEN source_size = 0 THEN 0 ELSE words % source_size END AS budget
            FROM judged LEFT JOIN level ON true
        ), ordered AS (
            SELECT s.*, t.source_size, t.target, t.whole, t.budget,
                sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash) AS upto
            FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
        ), points AS (
            SELECT source, min(hash) AS point FROM ordered
            WHERE budget > 0 AND upto > budget GROUP BY source
        ), depths AS (
            SELECT s.source, point, depth
            FROM sized s JOIN points p ON s.source IS NOT DISTINCT FROM p.source
            CROSS JOIN range({mixing.LEVELS + 1}) AS d(depth)
            WHERE s.hash >> ({mixing.HASH_BITS} - {mixing.LEVEL_BITS} * depth)
                = point >> ({mixing.HASH_BITS} - {mixing.LEVEL_BITS} * depth)
            GROUP BY s.source, point, depth
            HAVING count(*) <= {mixing.BUCKET_ROWS} OR depth = {mixing.LEVELS}
        ), buckets AS (
            SELECT source, {mixing.HASH_BITS} - {mixing.LEVEL_BITS} * min(depth) AS bits,
                any_value(point) >> ({mixing.HASH_BITS} - {mixing.LEVEL_BITS} * min(depth)) AS bucket
            FROM depths GROUP BY source
        ), placed AS (
            SELECT o.*, sign(coalesce((hash >> bits) - bucket, 1)) AS side
            FROM ordered o LEFT JOIN buckets b ON o.source IS NOT DISTINCT FROM b.source
        ), ties AS (
            SELECT source, hash, size, count(*) AS n,
                row_number() OVER (PARTITION BY source ORDER BY hash, size) AS turn
            FROM placed WHERE side = 0 GROUP BY source, hash, size
        ), filled AS (
            SELECT source, CAST(0 AS BIGINT) AS turn, CAST(NULL AS BIGINT) AS hash,
                CAST(NULL AS BIGINT) AS size, CAST(0 AS HUGEINT) AS taken,
                CAST(any_value(budget) - coalesce(sum(size) FILTER (side < 0), 0) AS HUGEINT) AS free
            FROM placed GROUP BY source
            UNION ALL
            SELECT t.source, t.turn, t.hash, t.size,
                CASE WHEN t.size = 0 THEN t.n ELSE least(t.n, f.free // t.size) END,
                f.free - CASE WHEN t.size = 0 THEN 0 ELSE t.size * least(t.n, f.free // t.size) END
            FROM filled f JOIN ties t
            ON f.source IS NOT DISTINCT FROM t.source AND t.turn = f.turn + 1
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY source, hash, size) AS number FROM placed
        )
        SELECT p.doc_id, p.size, p.source_size, p.target,
            CAST(p.size * (p.whole + CASE WHEN side < 0 THEN 1
                WHEN side = 0 AND number <= f.taken THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM numbered p LEFT JOIN filled f
        ON p.source IS NOT DISTINCT FROM f.source AND p.hash = f.hash AND p.size = f.size
    """,
    "op12_source_divergence": rf"""
        WITH docs AS (
            SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang,
                coalesce(source, '') AS source,
                regexp_extract_all(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '{divergence.TERM}') AS words
            FROM documents
        ), words AS (
            SELECT doc, lang, source, unnest(words) AS term FROM docs
        ), kept AS (
            SELECT lang, term, count(*) AS count FROM words GROUP BY lang, term
            HAVING count(DISTINCT doc) >= {divergence.MIN_DOCUMENTS}
        ), langs AS (
            SELECT lang, count(*) AS v, sum(count) AS n FROM kept GROUP BY lang
        ), counts AS (
            SELECT lang, source, term, count(*) AS count
            FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
        ), sums AS (
            SELECT lang, source, sum(count) AS n FROM counts GROUP BY lang, source
        ), groups AS (
            SELECT g.lang, g.source, coalesce(s.n, 0) AS n, coalesce(l.v, 0) AS v
            FROM (SELECT DISTINCT lang, source FROM docs) g
            LEFT JOIN sums s USING (lang, source) LEFT JOIN langs l USING (lang)
        ), shares AS (
            SELECT g.lang, g.source, k.term, coalesce(c.count, 0) AS count,
                1 + CAST({divergence.SCALE} AS HUGEINT) * (coalesce(c.count, 0) + 1) // (g.n + g.v) AS p,
                1 + CAST({divergence.SCALE} AS HUGEINT) * (k.count + 1) // (l.n + l.v) AS q
            FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), pair AS (
            SELECT a.lang, a.source, b.source AS item,
                CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
            FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source
            GROUP BY ALL
        ), pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
        ), terms AS (
            SELECT lang, source, 'term' AS part, term AS item,
                CAST((p - q) * (p - q) // q AS BIGINT) AS value
            FROM shares WHERE count > 0 AND p > q
        )
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part
            ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM (FROM pairs UNION ALL FROM terms)
        QUALIFY part = 'pair' OR rank <= {divergence.TOP_TERMS}
    """,
    "op13_phrase_collocations": rf"""
        WITH pieces AS (
            SELECT coalesce(lang, '{collocations.UNKNOWN}') AS lang,
                unnest(regexp_split_to_array(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), runs AS (
            SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
        ), spots AS (
            SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM runs
        ), phrases AS (
            SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase
            FROM spots CROSS JOIN range(1, {collocations.MOST_WORDS + 1}) AS r(k)
            WHERE i + k - 1 <= len(words)
        ), counts AS (
            SELECT lang, k, phrase, count(*) AS f FROM phrases GROUP BY ALL
        ), totals AS (
            SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang
        ), frequent AS (
            SELECT *, string_split(phrase, ' ') AS words FROM counts
            WHERE f >= {collocations.MIN_COUNT}
        ), cuts AS (
            SELECT lang, phrase, f AS a, unnest(range(1, k)) AS cut, words FROM frequent WHERE k > 1
        ), scored AS (
            SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
                CAST(CAST({collocations.SCALE} AS HUGEINT) * c.a * c.a
                    // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM cuts c
            JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(words[:cut], ' ')
            JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(words[cut + 1:], ' ')
        ), worst AS (
            FROM scored
            QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
        ), covers AS (
            SELECT lang, array_to_string(words[i:i + n - 1], ' ') AS phrase, max(f) AS cover
            FROM frequent, range(2, {collocations.MOST_WORDS}) AS r(n),
                range(1, {collocations.MOST_WORDS}) AS s(i)
            WHERE n < k AND i + n - 1 <= k
            GROUP BY ALL
        )
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
            phrase, a, l, r, n, score
        FROM worst LEFT JOIN covers USING (lang, phrase) JOIN totals USING (lang)
        WHERE coalesce(100 * cover < {collocations.COVERED_PERCENT} * a, true)
        QUALIFY rank <= {collocations.BEST}
    """,
}
