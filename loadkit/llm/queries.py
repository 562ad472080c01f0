"""The registered queries of this subpackage, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.checks import workspace
from loadkit.llm.common import table, texts
from loadkit.llm.conversations import audits, damage_turns, repair_turns
from loadkit.llm.divergence import divergence
from loadkit.llm.embeddings import near_duplicates
from loadkit.llm.exact_dedup import DigestIndex
from loadkit.llm.fingerprints import fingerprints
from loadkit.llm.jaccard import similar_groups
from loadkit.llm.language import predict_languages
from loadkit.llm.language_model import model_scores
from loadkit.llm.mixing import SCHEDULE, mix
from loadkit.llm.pieces import decode_pieces, encode_pieces
from loadkit.llm.quality import classify_quality
from loadkit.llm.secrets import scan_secrets, secret_digest
from loadkit.llm.token_files import TokenStore, with_checksums, write_tokens
from loadkit.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the name of its function."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return register


@query(
    """
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
            sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
        FROM documents
    ), g AS (
        SELECT *, first_value(doc_id) OVER (
                PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
            count(*) OVER (PARTITION BY text_sha256) AS group_size
        FROM d
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """
)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicate all documents against an index that this load fills."""
    index = DigestIndex(spark, f"{workspace(spark)}.digests")
    return index.deduplicate(table(spark, sf_dir, "documents"), "first")


def _position_sql() -> str:
    """The inverse of the default schedule as SQL, for a share `share` and a rank `rank`."""
    cases = []
    for turn, phases in enumerate(SCHEDULE):
        total, done, pieces = sum(phases), 0.0, []
        for i, height in enumerate(phases):
            width = height / total
            pieces.append(
                f"WHEN share < {done + width!r}::DOUBLE THEN"
                f" ({float(i)}::DOUBLE + (share - {done!r}::DOUBLE) / {width!r}::DOUBLE)"
                f" / {float(len(phases))}::DOUBLE"
            )
            done += width
        cases.append(f"WHEN (rank - 1) % {len(SCHEDULE)} = {turn} THEN CASE {' '.join(pieces)} ELSE 1.0 END")
    return f"CASE {' '.join(cases)} END"


@query(
    f"""
    WITH d AS (
        SELECT doc_id, source,
            len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
        FROM documents
    ), s AS (
        SELECT source, sum(size)::BIGINT AS source_size,
            row_number() OVER (ORDER BY source NULLS LAST) AS rank
        FROM d GROUP BY source
    ), w AS (
        SELECT *, (rank - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM s
    ), f AS (
        SELECT *,
            row_number() OVER o AS turn,
            (sum(source_size) OVER () - coalesce(sum(cap) OVER p, 0))::DOUBLE AS words_left,
            (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0))::DOUBLE AS weight_left
        FROM w
        WINDOW o AS (ORDER BY cap::DOUBLE / weight::DOUBLE, rank),
            p AS (ORDER BY cap::DOUBLE / weight::DOUBLE, rank
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), x AS (
        SELECT *, min(CASE WHEN words_left * weight / weight_left < cap THEN turn END) OVER ()
            AS first_open
        FROM f
    ), t AS (
        SELECT *, CASE WHEN first_open IS NULL OR turn < first_open THEN cap::DOUBLE
            ELSE max(CASE WHEN turn = first_open THEN words_left END) OVER () * weight
                / max(CASE WHEN turn = first_open THEN weight_left END) OVER () END AS target
        FROM x
    ), c AS (
        SELECT d.doc_id, d.size, t.rank, t.source_size, t.target,
            coalesce(sum(d.size) OVER (
                PARTITION BY t.rank ORDER BY md5(d.doc_id::VARCHAR), d.doc_id
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS earlier,
            CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS passes
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    ), k AS (
        SELECT *, CASE WHEN size = 0 THEN 0 ELSE passes::BIGINT + CASE WHEN
            (2 * earlier + size)::DOUBLE <= 2.0::DOUBLE * (target - passes * source_size)
            THEN 1 ELSE 0 END END AS copies,
            (earlier * 2 + size)::DOUBLE / (2.0::DOUBLE * target) AS share
        FROM c
    )
    SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken,
        copies::INTEGER AS copies,
        CASE WHEN copies > 0 THEN {_position_sql()} END AS position
    FROM k
    """
)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents by the default weights and schedule."""
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "position"
    )


@query()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predict the language of all documents."""
    return predict_languages(table(spark, sf_dir, "documents"))


@query()
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find the secrets of all documents."""
    return secret_digest(scan_secrets(table(spark, sf_dir, "documents")))


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score the quality of all documents."""
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all documents to a token store and read it back."""
    path = scratch_path(spark, "tokens")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    write_tokens(table(spark, sf_dir, "documents"), path, vocabulary, end_id=2)
    return with_checksums(TokenStore(spark, path).documents(tokens=True))


@query()
def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents to pieces and decode them again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    rows = encode_pieces(texts(table(spark, sf_dir, "documents")), model, name="tokens")
    rows = decode_pieces(rows, model, "tokens").select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_pieces"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
        "tokens",
    )
    return with_checksums(rows)


@query()
def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score all documents by the language model."""
    return model_scores(table(spark, sf_dir, "documents"))


@query(
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    ), ok AS (
        SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
            AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
            AND len(list_filter(e, lambda x: x <> 0)) > 0
    ), links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            AND list_cosine_similarity(a.e, b.e) >= 0.93
    ), reach AS (
        SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ), smallest AS (
        SELECT a, min(b) AS b FROM reach GROUP BY a
    ), counted AS (
        SELECT a, count(*) AS n FROM links GROUP BY a
    )
    SELECT vec_id, coalesce(n, 0) AS n_links,
        least(vec_id, coalesce(smallest.b, vec_id)) AS component_id,
        vec_id = least(vec_id, coalesce(smallest.b, vec_id)) AS kept
    FROM v LEFT JOIN counted ON counted.a = vec_id LEFT JOIN smallest ON smallest.a = vec_id
    """
)
def op6_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link and group near-duplicates of all embeddings."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


@query(
    """
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x20\\x09-\\x0D]+') AS words
        FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS gram
        FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2)::BIGINT)) AS i FROM w WHERE len(words) > 0)
    ), n AS (
        SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
    ), c AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS (
        SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
        WHERE 100 * c >= 85 * (x.n + y.n - c)
    ), reach AS (
        SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
    ), smallest AS (
        SELECT a, min(b) AS b FROM reach GROUP BY a
    )
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id
    FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN smallest ON a = doc_id
    """
)
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group all documents by similar sets of four words."""
    return similar_groups(table(spark, sf_dir, "documents"), words=4, percent=85)


@query(
    r"""
    WITH RECURSIVE raw AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                lambda c: ord(c)::BIGINT) AS key
        FROM conversations
    ), drawn AS (
        SELECT conv_id, turn, role, text, xor(4294967295::BIGINT, list_reduce(
            list_prepend(4294967295::BIGINT, key), lambda a, b: list_reduce(
                list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END::BIGINT)))) % 20 AS draw
        FROM raw
    ), rows AS (
        SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role,
            CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(range(CASE draw WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
        FROM drawn
    ), placed AS (
        SELECT *, row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i
        FROM rows
    ), told AS (
        SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
            NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut,
            lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
        FROM placed
    ), counts AS (
        SELECT conv_id, count(*) AS n,
            coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen) AS duplicate,
            count(*) FILTER (NOT blank AND NOT seen AND cut) AS truncated,
            count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM told GROUP BY conv_id
    ), steps AS (
        -- Per state the cost in 12 digits and the edits so far; inserts come before a row.
        SELECT DISTINCT conv_id, 0 AS i, '000000000000' AS v0, NULL::VARCHAR AS vs, NULL::VARCHAR AS vu,
            NULL::VARCHAR AS va FROM told
        UNION ALL
        SELECT conv_id, i, d0, CASE WHEN free AND initial = 's' THEN least(ds, k0) ELSE ds END,
            CASE WHEN NOT free THEN du WHEN initial = 'u' THEN least(du, r0, rs, ra, k0, ks, ka)
                ELSE least(du, r0, rs, ra) END,
            CASE WHEN NOT free THEN da WHEN initial = 'a' THEN least(da, ru, ku) ELSE least(da, ru) END
        FROM (
            SELECT conv_id, i, initial, free,
                lpad((left(v0, 12)::BIGINT + 2)::VARCHAR, 12, '0') || substr(v0, 13) || 'D' AS d0,
                lpad((left(vs, 12)::BIGINT + 2)::VARCHAR, 12, '0') || substr(vs, 13) || 'D' AS ds,
                lpad((left(vu, 12)::BIGINT + 2)::VARCHAR, 12, '0') || substr(vu, 13) || 'D' AS du,
                lpad((left(va, 12)::BIGINT + 2)::VARCHAR, 12, '0') || substr(va, 13) || 'D' AS da,
                lpad((left(v0, 12)::BIGINT + more)::VARCHAR, 12, '0') || substr(v0, 13) || 'K' AS k0,
                lpad((left(vs, 12)::BIGINT + more)::VARCHAR, 12, '0') || substr(vs, 13) || 'K' AS ks,
                lpad((left(vu, 12)::BIGINT + more)::VARCHAR, 12, '0') || substr(vu, 13) || 'K' AS ku,
                lpad((left(va, 12)::BIGINT + more)::VARCHAR, 12, '0') || substr(va, 13) || 'K' AS ka,
                lpad((left(v0, 12)::BIGINT + more + 1)::VARCHAR, 12, '0') || substr(v0, 13) || 'R' AS r0,
                lpad((left(vs, 12)::BIGINT + more + 1)::VARCHAR, 12, '0') || substr(vs, 13) || 'R' AS rs,
                lpad((left(vu, 12)::BIGINT + more + 1)::VARCHAR, 12, '0') || substr(vu, 13) || 'R' AS ru,
                lpad((left(va, 12)::BIGINT + more + 1)::VARCHAR, 12, '0') || substr(va, 13) || 'R' AS ra
            FROM (
                SELECT s.conv_id, t.i, t.initial, NOT blank AND NOT seen AS free,
                    CASE WHEN cut THEN 5 ELSE 0 END AS more, v0, vs, vu,
                    least(va, lpad((left(vu, 12)::BIGINT + 5)::VARCHAR, 12, '0') || substr(vu, 13) || 'I') AS va
                FROM (
                    SELECT conv_id, i, v0, vs, least(vu,
                        lpad((left(v0, 12)::BIGINT + 5)::VARCHAR, 12, '0') || substr(v0, 13) || 'I',
                        lpad((left(vs, 12)::BIGINT + 5)::VARCHAR, 12, '0') || substr(vs, 13) || 'I',
                        lpad((left(va, 12)::BIGINT + 5)::VARCHAR, 12, '0') || substr(va, 13) || 'I') AS vu, va
                    FROM steps
                ) s JOIN told t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.i = s.i + 1
            )
        )
    ), last_step AS (
        SELECT conv_id, v0, va, least(vu,
            lpad((left(v0, 12)::BIGINT + 5)::VARCHAR, 12, '0') || substr(v0, 13) || 'I',
            lpad((left(vs, 12)::BIGINT + 5)::VARCHAR, 12, '0') || substr(vs, 13) || 'I') AS vu
        FROM steps JOIN counts USING (conv_id) WHERE i = n
    ), best AS (
        SELECT conv_id, least(v0, va,
            lpad((left(vu, 12)::BIGINT + 5)::VARCHAR, 12, '0') || substr(vu, 13) || 'I') AS v
        FROM last_step
    ), letters AS (
        SELECT conv_id, unnest(string_split(substr(v, 13), '')) AS edit,
            unnest(range(1, length(v) - 11)) AS place
        FROM best WHERE length(v) > 12
    ), numbered AS (
        SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS out,
            count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id) AS n_out
        FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY place)
    ), lines AS (
        SELECT l.conv_id, place, CASE WHEN edit = 'K' THEN role
            WHEN (out - n_out % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END
            || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line
        FROM numbered l JOIN told t ON t.conv_id = l.conv_id AND t.i = greatest(l.i, 1)
        WHERE edit <> 'D'
    ), texts AS (
        SELECT conv_id, string_agg(line, chr(10) ORDER BY place) AS text FROM lines GROUP BY conv_id
    )
    SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
        coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
        coalesce(illegal, 0)::BIGINT AS illegal, coalesce(left(v, 12)::BIGINT, 0)::BIGINT AS cost,
        coalesce(substr(v, 13), '') AS audit, sha256(coalesce(texts.text, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN counts USING (conv_id)
        LEFT JOIN best USING (conv_id) LEFT JOIN texts USING (conv_id)
    """
)
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage all conversations and repair them."""
    return audits(repair_turns(damage_turns(table(spark, sf_dir, "conversations"))))


@query(
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS no, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
        FROM documents
    ), w AS (
        SELECT no, lang, source, unnest(found) AS term FROM d
    ), kept AS (
        SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT no) >= 3
    ), l AS (
        SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang
    ), c AS (
        SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
    ), g AS (
        SELECT lang, source, coalesce(any_value(l.v), 0) AS v, coalesce(any_value(l.n), 0) AS lang_n,
            coalesce(sum(c.n), 0) AS n
        FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN l USING (lang)
        GROUP BY lang, source
    ), p AS (
        SELECT lang, source, term, coalesce(c.n, 0) AS n, total,
            1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n + v) AS p,
            1 + 1000000000::HUGEINT * (total + 1) // (lang_n + v) AS q
        FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)
    ), pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), valued AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM valued
    )
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
    WHERE part = 'pair' OR rank <= 200
    """
)
def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit the divergence of all sources of the documents."""
    return divergence(table(spark, sf_dir, "documents"))


@query()
def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint all documents and their edited texts."""
    return fingerprints(table(spark, sf_dir, "documents"))
