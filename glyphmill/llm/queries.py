"""The queries opN_<name> of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import sharding as S

    done = S.shard(_read(spark, sf_dir, "documents"))
    text = F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    return done.select("doc_id", S.record_size(F.col("row.text")).alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"), "shard", "slot", S.shard_of(F.col("doc_id"), S.SHARDS + 1).alias("grown_shard"))


def op2_substring_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import substrings as S

    return S.report(_read(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity as T

    scored = T.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return scored.select("doc_id", T.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").cast("bigint").alias("n_spans"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontamination as D

    return D.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import units as U

    done = U.deduplicate(_read(spark, sf_dir, "documents"))
    removed = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return done.select("doc_id", "n_removed", "n_units", removed.alias("removed"), "kept_sha256")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html as H

    return H.extract(_read(spark, sf_dir, "pages"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jaccard as J

    return J.classes(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import packing as P

    return P.tokenise(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mixing as M

    return M.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality as Q

    return Q.quality_report(_read(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


QUERIES = {f.__name__: f for f in (op1_sharding, op2_substring_removal, op3_toxicity, op4_decontamination, op5_line_dedup, op6_html_extraction, op7_jaccard_join, op8_token_ids, op9_source_mixing, op10_quality_rules)}

ORACLE_SQL = {
    "op5_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, l, string_split(text, chr(10))[l] AS line
            FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS l FROM documents WHERE text <> '')
        ), placed AS (
            SELECT *, regexp_extract_all(line, '[^ \t-\r]+') AS w, regexp_split_to_array(line, '[^ \t-\r]+') AS gaps,
                   coalesce(sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY l ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS base
            FROM lines
        ), words AS (
            SELECT doc_id, l, k, word, total, (base + sum(strlen(gap) + strlen(word)) OVER (PARTITION BY doc_id, l ORDER BY k) - strlen(word))::BIGINT AS start
            FROM (SELECT doc_id, l, base, len(w) AS total, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS word, unnest(gaps[1:len(w)]) AS gap FROM placed WHERE len(w) > 0)
        ), numbered AS (
            SELECT *, start + strlen(word) AS stop, row_number() OVER (PARTITION BY doc_id ORDER BY l, k) AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM words
        ), may AS (
            SELECT doc_id, i FROM numbered WHERE k = total OR total >= 8 AND total - k >= 8 AND regexp_matches(word, '[.!?,;:]$')
        ), jump AS (
            SELECT a.doc_id, a.i, coalesce(b.i, a.n) AS last FROM numbered a ASOF LEFT JOIN may b ON a.doc_id = b.doc_id AND a.i + 7 <= b.i
        ), chains AS (
            SELECT doc_id, list_reduce(list_prepend([1::BIGINT], list_transform(range(n // 8 + 1), lambda x: []::BIGINT[])), lambda c, x: CASE WHEN c[-1] > n THEN c ELSE list_append(c, jumps[c[-1]] + 1) END) AS chain
            FROM (SELECT doc_id, count(*) AS n, list(last ORDER BY i) AS jumps FROM jump GROUP BY doc_id)
        ), units AS (
            SELECT doc_id, unnest(chain[:-2]) AS first, unnest(chain[2:]) - 1 AS last FROM chains
        ), made AS (
            SELECT u.doc_id, u.first, u.last, translate(string_agg(x.word, ' ' ORDER BY x.i), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS plain
            FROM units u JOIN numbered x ON x.doc_id = u.doc_id AND x.i BETWEEN u.first AND u.last GROUP BY u.doc_id, u.first, u.last
        ), ranked AS (
            SELECT m.doc_id, m.first, row_number() OVER (PARTITION BY plain ORDER BY m.doc_id, m.first) > 1 AS gone,
                   CASE WHEN f.k = 1 THEN f.start ELSE p.stop END AS a, CASE WHEN f.k = 1 THEN coalesce(s.start, strlen(d.text)) ELSE e.stop END AS b
            FROM made m JOIN documents d ON d.doc_id = m.doc_id JOIN numbered f ON f.doc_id = m.doc_id AND f.i = m.first JOIN numbered e ON e.doc_id = m.doc_id AND e.i = m.last
            LEFT JOIN numbered p ON p.doc_id = m.doc_id AND p.i = m.first - 1 LEFT JOIN numbered s ON s.doc_id = m.doc_id AND s.i = m.last + 1
        ), heads AS (
            SELECT doc_id, first, a, b, coalesce(a > max(b) OVER (PARTITION BY doc_id ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS new FROM ranked WHERE gone
        ), spans AS (
            SELECT doc_id, min(a)::BIGINT AS a, max(b)::BIGINT AS b FROM (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY first) AS g FROM heads) GROUP BY doc_id, g
        ), pieces AS (
            SELECT d.doc_id, unnest(list_zip(list_prepend(0, list(b ORDER BY a)), list_append(list(a ORDER BY a), strlen(any_value(text))))) AS x, any_value(encode(text)) AS raw
            FROM spans s JOIN documents d ON d.doc_id = s.doc_id GROUP BY d.doc_id
        ), kept AS (SELECT doc_id, string_agg(decode(substr_blob), '' ORDER BY x[1]) AS text FROM (SELECT doc_id, x, raw[x[1] + 1:x[2]] AS substr_blob FROM pieces) GROUP BY doc_id),
        counts AS (SELECT doc_id, count(*) AS n_units, count(*) FILTER (gone) AS n_removed FROM ranked GROUP BY doc_id),
        named AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS removed FROM spans GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(removed, '') AS removed, sha256(coalesce(k.text, d.text, '')) AS kept_sha256
        FROM documents d LEFT JOIN counts c ON c.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id""",
    "op9_source_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+'))::BIGINT AS size,
                   -ln((('0x' || substr(md5('20|' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656.0::DOUBLE)
                   / CASE WHEN length(coalesce(text, '')) > 0 THEN 1::DOUBLE - 0.75::DOUBLE * len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::DOUBLE / length(coalesce(text, ''))::DOUBLE ELSE 1.0::DOUBLE END AS key
            FROM documents
        ), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, ([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight, (3 * source_size)::DOUBLE AS cap FROM s),
        l AS (
            SELECT *, (sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level FROM w
        ), t AS (SELECT source, source_size, least(cap, weight * (SELECT arg_min(level, cap / weight) FROM l WHERE level <= cap / weight)) AS target FROM l),
        m AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
                     sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, round(target, 6) AS target, (epochs * size + greatest(0, least(size, round(target - epochs * source_size)::BIGINT - before)))::BIGINT AS taken FROM m""",
    "op10_quality_rules": r"""
        WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS words,
                          list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines FROM documents),
        windows AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS s FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
        twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS c FROM windows) WHERE c > 1),
        covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM twice) GROUP BY doc_id),
        base AS (SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
                        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, len(lines)::BIGINT AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN covered c ON w.doc_id = c.doc_id),
        m AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, (2 * n_symbols + 1) * 500000 // (word_chars + 1) AS a, (2 * n_dup_lines + 1) * 500000 // (n_lines + 1) AS b, CASE WHEN n_words > 0 THEN word_chars * 1000 // n_words END AS c FROM base),
        own AS (SELECT lang, source FROM m GROUP BY lang, source),
        voters AS (SELECT * FROM m WHERE n_words >= 10),
        levels AS (
            SELECT 1 AS level, lang, source, count(*) AS n, list_sort(list(a)) AS a, list_sort(list(b)) AS b, list_sort(list(c)) AS c FROM voters GROUP BY lang, source
            UNION ALL SELECT 2, lang, NULL, count(*), list_sort(list(a)), list_sort(list(b)), list_sort(list(c)) FROM voters GROUP BY lang
            UNION ALL SELECT 3, NULL, NULL, count(*), list_sort(list(a)), list_sort(list(b)), list_sort(list(c)) FROM voters
        ), q AS (SELECT level, lang, source, a[i] AS a1, a[j] AS a3, b[i] AS b1, b[j] AS b3, c[i] AS c1, c[j] AS c3 FROM (SELECT *, ceil(0.25 * n)::BIGINT AS i, ceil(0.75 * n)::BIGINT AS j FROM levels WHERE n >= 20)),
        f AS (SELECT level, lang, source, CASE WHEN a1 < a3 THEN a3::DOUBLE * (a3::DOUBLE / a1::DOUBLE) * (a3::DOUBLE / a1::DOUBLE) * (a3::DOUBLE / a1::DOUBLE) END AS fa,
                     CASE WHEN b1 < b3 THEN b3::DOUBLE * (b3::DOUBLE / b1::DOUBLE) * (b3::DOUBLE / b1::DOUBLE) * (b3::DOUBLE / b1::DOUBLE) END AS fb, CASE WHEN c1 < c3 THEN (c3 + 6 * (c3 - c1))::DOUBLE END AS fc FROM q),
        fence AS (
            SELECT own.lang, own.source, coalesce(x.fa, y.fa, z.fa) AS fa, coalesce(x.fb, y.fb, z.fb) AS fb, coalesce(x.fc, y.fc, z.fc) AS fc
            FROM own LEFT JOIN f x ON x.level = 1 AND x.lang IS NOT DISTINCT FROM own.lang AND x.source IS NOT DISTINCT FROM own.source
            LEFT JOIN f y ON y.level = 2 AND y.lang IS NOT DISTINCT FROM own.lang LEFT JOIN f z ON z.level = 3
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR coalesce(a > fa, false) OR coalesce(b > fb, false) OR coalesce(c > fc, false)) AS kept
        FROM m LEFT JOIN fence ON m.lang IS NOT DISTINCT FROM fence.lang AND m.source IS NOT DISTINCT FROM fence.source""",
    "op4_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        phrases AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS i FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM phrases),
        windows AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
        found AS (SELECT doc_id, i, n, item_id FROM windows JOIN phrases USING (n, s)),
        hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id""",
    "op7_jaccard_join": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t-\r]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(doc_id, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM reach r JOIN edges e ON r.doc_id = e.a),
        least AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN least l ON d.doc_id = l.doc_id""",
}
