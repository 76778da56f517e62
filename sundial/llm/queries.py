"""Registered queries of the text operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sundial.llm import bpe, chat, contamination, fingerprints, jaccard, language, merkle, mixing, negatives, ppm, repeats, secrets, warc
from sundial.llm.shared import small_batches

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BPE_PATTERN = public_tokenizers.PATTERN


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text by the public ranks, and the round trip back to bytes."""
    return bpe.digests(_table(spark, folder, "documents"), BPE_RANKS, BPE_PATTERN)


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Strong secrets of every document and weak candidates linked by co-occurrence."""
    return secrets.report(_table(spark, folder, "documents"))


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Shingle set size and near-duplicate component of every document."""
    return jaccard.join(_table(spark, folder, "documents"))


def language_training(documents: DataFrame) -> DataFrame:
    """The documents that language identification may learn from."""
    return documents.where(~language.held_out())


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    documents = _table(spark, folder, "documents")
    found = language.identify(documents.withColumn("held_out", language.held_out()), language_training(documents), ["doc_id", "held_out"])
    return found


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items inside documents: every pair with containment of 0.75 or more."""
    return contamination.contained(_table(spark, folder, "documents"), _table(spark, folder, "benchmark")).select("doc_id", "item_id", "n_item", "n_shared", "containment")


def op6_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents by a byte model and by word frequencies, both learned from six sevenths of them."""
    documents = _table(spark, folder, "documents").withColumn("held_out", ppm.held_out())
    return ppm.pretrained(documents, documents.where("NOT held_out"), ["doc_id", "held_out"])


def op7_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    """Lines, paragraphs, windows of 30 words and runs of sentences that repeat an earlier one, by document."""
    return repeats.report(_table(spark, folder, "documents"), every=True)


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a record of normalised archives, read back through their index."""
    return warc.round_trip(_table(spark, folder, "pages")).drop("url", "payload")


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Repaired and rendered conversations."""
    return chat.repaired(_table(spark, folder, "conversations"))


def op10_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Prefix-hash fingerprints of every text and its edited text."""
    return fingerprints.fingerprints(_table(spark, folder, "documents"))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Merkle manifest of all documents by source, and every document's proof held against the root."""
    return merkle.report(_table(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector and each of its positives."""
    return negatives.report(_table(spark, folder, "embeddings"))


def op13_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix of all sources takes of every document, and when."""
    return mixing.report(_table(spark, folder, "documents"))


def _moment_sql(done: str, schedule: mixing.Schedule) -> str:
    """mixing.moment as SQL, for schedules that never touch zero."""
    parts = list(zip(schedule, schedule[1:]))
    areas = [(b - a) * (g + h) / 2 for (a, g), (b, h) in parts]
    result, before = f"{float(schedule[-1][0])}::DOUBLE", sum(areas)
    for (a, g), (b, h), area in reversed(list(zip(*zip(*parts), areas))):
        before -= area
        rest = f"greatest({done} * {sum(areas)}::DOUBLE - {before}::DOUBLE, 0)"
        step = f"2 * {rest} / ({g}::DOUBLE + sqrt(greatest({g * g}::DOUBLE + {2 * (h - g) / (b - a)}::DOUBLE * {rest}, 0)))"
        result = f"CASE WHEN {done} * {sum(areas)}::DOUBLE < {before + area}::DOUBLE THEN {a}::DOUBLE + least({step}, {b - a}::DOUBLE) ELSE {result} END"
    return result


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_language_id": op3_language_id,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_decontamination": op5_decontamination,
    "op6_lm_score": op6_lm_score,
    "op7_repeated_passages": op7_repeated_passages,
    "op8_warc": op8_warc,
    "op9_chat_format": op9_chat_format,
    "op10_fingerprints": op10_fingerprints,
    "op11_merkle": op11_merkle,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_mixing": op13_mixing,
}

SQL: dict[str, str] = {
    "op5_decontamination": """
        WITH words AS (
            SELECT 'd' AS side, doc_id AS id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
            UNION ALL SELECT 'b', item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') FROM benchmark),
        item AS (
            SELECT DISTINCT id AS item_id, least(len(w), 5) AS width, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS s
            FROM (SELECT id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM words WHERE side = 'b' AND len(w) > 0)),
        widths AS (SELECT DISTINCT width FROM item),
        doc AS (
            SELECT DISTINCT id AS doc_id, width, array_to_string(w[i:i + width - 1], ' ') AS s
            FROM (SELECT id, w, width, unnest(range(1, len(w) - width + 2)) AS i FROM words, widths WHERE side = 'd' AND len(w) >= width)),
        size AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id),
        shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM doc JOIN item USING (width, s) GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment FROM shared JOIN size USING (item_id) WHERE n_shared >= 0.75 * n_item""",
    "op8_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        q AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS first_id FROM p)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to FROM q""",
    "op11_merkle": """
        WITH RECURSIVE f AS (
            SELECT doc_id, source, text, concat(CASE WHEN doc_id IS NULL THEN '-' ELSE concat(strlen(doc_id::VARCHAR), ':', doc_id) END,
                       CASE WHEN source IS NULL THEN '-' ELSE concat(strlen(source), ':', source) END, CASE WHEN lang IS NULL THEN '-' ELSE concat(strlen(lang), ':', lang) END,
                       CASE WHEN n_chars IS NULL THEN '-' ELSE concat(strlen(n_chars::VARCHAR), ':', n_chars) END) AS head,
                   coalesce(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                       lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)) % 2 = 1, false) AS tampered
            FROM documents),
        leaves AS (
            SELECT doc_id, source, sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(text), ':', text) END)) AS leaf,
                   CASE WHEN tampered THEN sha256(concat(head, CASE WHEN text IS NULL THEN '-' ELSE concat(strlen(replace(text, chr(10), '')), ':', replace(text, chr(10), '')) END)) END AS given
            FROM f),
        placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM leaves),
        level AS (
            SELECT source, 0 AS k, list(leaf ORDER BY pos) AS nodes FROM placed GROUP BY source
            UNION ALL SELECT source, k + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], ''))) FROM level WHERE len(nodes) > 1),
        subs AS (SELECT source, nodes[1] AS subroot, k AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM level WHERE len(nodes) = 1),
        upper AS (
            SELECT 0 AS k, list(subroot ORDER BY i) AS nodes FROM subs
            UNION ALL SELECT k + 1, list_transform(range(0, (len(nodes) + 2) // 3), lambda i: sha256(array_to_string(nodes[3 * i + 1:3 * i + 3], ''))) FROM upper WHERE len(nodes) > 1),
        steps AS (
            SELECT p.doc_id, p.leaf, p.given, s.subroot, l.k, pos // pow(3, l.k)::BIGINT AS own, l.nodes FROM placed p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source JOIN level l ON l.source IS NOT DISTINCT FROM p.source WHERE len(l.nodes) > 1
            UNION ALL SELECT p.doc_id, p.leaf, p.given, s.subroot, s.height + u.k, s.i // pow(3, u.k)::BIGINT, u.nodes FROM placed p JOIN subs s ON s.source IS NOT DISTINCT FROM p.source CROSS JOIN upper u WHERE len(u.nodes) > 1),
        parts AS (
            SELECT doc_id, leaf, given, subroot, k, array_to_string(nodes[own - own % 3 + 1:own], '') AS l, array_to_string(nodes[own + 2:own - own % 3 + 3], '') AS r FROM steps),
        paths AS (SELECT doc_id, leaf, given, subroot, string_agg(concat(l, r), '' ORDER BY k) AS siblings, list(l ORDER BY k) AS ls, list(r ORDER BY k) AS rs FROM parts GROUP BY ALL),
        ends AS (
            SELECT doc_id, leaf, subroot, (SELECT nodes[1] FROM upper WHERE len(nodes) = 1) AS root, sha256(siblings) AS proof_sha256,
                   list_reduce(list_prepend(coalesce(given, leaf), list_transform(range(1, len(ls) + 1), lambda i: i::VARCHAR)), lambda a, i: sha256(concat(ls[i::BIGINT], a, rs[i::BIGINT]))) AS folded_root
            FROM paths)
        SELECT *, folded_root = root AS verified FROM ends""",
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10""",
    "op13_mixing": f"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size, md5(concat_ws(':', 'mix', doc_id::VARCHAR, source)) AS mark FROM documents),
        g AS (SELECT source, sum(size)::BIGINT AS words, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS cycle FROM d GROUP BY source),
        w AS (SELECT *, 2 * words AS most, {list(mixing.WEIGHTS)}[cycle + 1] AS weight FROM g),
        k AS (SELECT sum(most) OVER o AS taken, sum(weight) OVER o AS used FROM w WINDOW o AS (ORDER BY most / weight, source ROWS UNBOUNDED PRECEDING) UNION ALL SELECT 0, 0),
        r AS (SELECT coalesce(max(((SELECT sum(words) FROM g) * 3 / 2::DOUBLE - taken) / ((SELECT sum(weight) FROM w) - used)), 0) AS rate FROM k WHERE used < (SELECT sum(weight) FROM w)),
        t AS (SELECT source, words, cycle, least(most::DOUBLE, weight * rate) AS target, floor(least(most::DOUBLE, weight * rate) + 0.5)::BIGINT AS take FROM w, r),
        c AS (
            SELECT doc_id, size, words AS source_size, target, cycle, take, i * words + coalesce(sum(size) OVER (PARTITION BY d.source, i ORDER BY mark, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, i
            FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source, range(2) x(i)),
        u AS (SELECT *, least(size, greatest(take - start, 0)) AS tokens, (start + tokens / 2) / take::DOUBLE AS done FROM c)
        SELECT doc_id, size, source_size, target, (tokens + lead(tokens, 1) OVER (PARTITION BY doc_id ORDER BY i))::BIGINT AS taken,
               round(CASE WHEN tokens > 0 THEN CASE cycle {' '.join(f'WHEN {i} THEN {_moment_sql("done", s)}' for i, s in enumerate(mixing.SCHEDULES))} END END, 6) AS first_position
        FROM u QUALIFY i = 0""",
}
