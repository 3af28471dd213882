"""Registered queries of the text operators, and DuckDB SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, hard_negatives, html_text, language, merkle, mixing, packing, quality, secret_scan, simhash, site_lines, suffix_dedup, warc
from .common import prepare, table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page; text model from labelled documents."""
    prepare(spark)
    languages, model = language.train(table(spark, sf_dir, "documents"))
    return language.identify(table(spark, sf_dir, "pages"), languages, model)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts and verdict of every document."""
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a WARC record and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat strings of documents with smaller ids."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every page without its host's boilerplate."""
    pages = table(spark, sf_dir, "pages")
    return site_lines.drop_site_boilerplate(pages, site_lines.html_lines(F.col("html")), site_lines.host(F.col("url"))).withColumnRenamed("site", "host")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces and their place in a sequence."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor's positives; labels of ids divisible by 7 are moved on by one."""
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document; a source is an owner, its documents of one language a repository."""
    return secret_scan.digests(secret_scan.scan(table(spark, sf_dir, "documents"), F.col("source"), F.col("lang")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the manifest; where 5 divides the crc32 of its id, a text in small letters is checked instead."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, merkle.leaf_digest([*fields, small]))
    manifest = merkle.build(docs, merkle.leaf_digest([*fields, F.col("text")]), F.col("source"), changed=changed)
    return manifest.checked().withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (op1_language_id, op2_quality_rules, op3_warc, op4_simhash, op5_html_extraction, op6_suffix_dedup, op7_mixing, op8_line_dedup, op9_packing, op10_exact_dedup, op11_hard_negatives, op12_secret_scan, op13_merkle_manifest)}

_RULES = ",\n".join(f"('{rule}', [{', '.join(map(str, cuts))}])" for rule, (_, cuts) in quality.RULES.items())


def _secret_sql() -> str:
    """Matches from the text between them; frequencies of hashes by owner and repository."""
    parts = []
    for k, (pattern, group, least) in enumerate([*secret_scan.BASE.values(), ("[A-Za-z0-9+/_.-]{8,}", 0, 8)]):
        pattern = pattern.replace("'", "''")
        parts.append(f"""SELECT rid, owner, repository, {k} AS kind, {least} AS least, regexp_extract_all(x, '{pattern}') AS found,
    regexp_extract_all(x, '{pattern}', {group}) AS vals, string_split_regex(x, '{pattern}') AS gaps FROM t""")
    words, base = len(secret_scan.BASE), ", ".join(f"'{k}'" for k in secret_scan.KINDS)
    kinds = ", ".join(f"count(*) FILTER (kind = {k}) AS n_{n}" for k, n in enumerate(secret_scan.BASE))
    return rf"""
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS owner, coalesce('=' || lang, '') AS repository, coalesce(text, '') AS x FROM documents),
m AS ({' UNION ALL '.join(parts)}),
c AS (SELECT rid, owner, repository, kind, vals[i] AS v, list_sum([length(s) FOR s IN gaps[1:i]] || [length(s) FOR s IN found[1:i]])::BIGINT AS "end", length(found[i]) AS size
    FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m) WHERE length(vals[i]) >= least),
e AS (SELECT rid, owner, repository, kind, v, "end" - size AS start, "end", sha256(regexp_replace(v, '[.=]+$', '')) AS hash FROM c
    WHERE kind < {words} OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]'))),
f AS (SELECT * FROM e WHERE kind < {words} OR NOT EXISTS (SELECT 1 FROM e AS b WHERE b.rid = e.rid AND b.kind < {words} AND b.start < e."end" AND b."end" > e.start)),
g AS (SELECT hash, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repository)) AS repositories, bool_or(kind = 0) AS assigned FROM f GROUP BY hash),
j AS (SELECT f.*, owners > {secret_scan.MAX_OWNERS} OR (owners > 1 AND repositories > {secret_scan.MAX_REPOSITORIES}) AS copied, assigned FROM f JOIN g USING (hash)),
s AS (SELECT *, [{base}][kind + 1] || ':' || start || ':' || "end" AS w FROM j WHERE kind < {words}
    OR (NOT copied AND (assigned OR (length(v) >= {secret_scan.LONG_WORD} AND regexp_matches(v, '[A-Z]') AND regexp_matches(v, '[a-z]'))))),
a AS (SELECT rid, {kinds}, string_agg(w, ',' ORDER BY start, kind, "end") FILTER (kind < {words}) AS own, string_agg(w, ',' ORDER BY start, kind, "end") AS spans,
    count(*) FILTER (kind = {words}) AS n_added, count(*) FILTER (copied) AS n_copied, count(*) FILTER (NOT copied) AS n_live FROM s GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{n}, 0) AS n_{n}' for n in secret_scan.BASE)}, sha256(coalesce(own, '')) AS base_sha256, coalesce(spans, '') AS spans,
    coalesce(n_added, 0) AS n_added, coalesce(n_copied, 0) AS n_copied, coalesce(n_live, 0) AS n_live FROM t LEFT JOIN a USING (rid)"""


def _merkle_sql(levels: int = 6) -> str:
    """The tree level by level, without blocks; {levels} levels hold 16^6 rows a source and as many sources."""
    fields = "|| ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END " for c in ("doc_id", "source", "lang", "n_chars", "TEXT"))
    small = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = "list_reduce([4294967295::BIGINT] || [ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')], lambda h, b: list_reduce([xor(h, b)] || [0::BIGINT FOR i IN range(8)], lambda a, j: xor(a >> 1, 3988292384 * (a & 1))))"
    sql = [f"""l AS (SELECT row_number() OVER () AS rid, doc_id, source, sha256({fields.replace('TEXT', 'text')}) AS leaf,
    CASE WHEN xor({crc}, 4294967295) % 5 = 0 THEN sha256({fields.replace('TEXT', small)}) END AS changed FROM documents)""",
           "s0 AS (SELECT rid, source AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, changed NULLS FIRST) - 1 AS i, leaf AS h, '' AS proof, coalesce(changed, leaf) AS fold FROM l)"]

    def climb(name: str, first: str) -> str:
        """name0 (rid, tree, i, h: node above the row) to the single nodes; a level is skipped once one node is left."""
        for k in range(levels):
            sql.append(f"n{name}{k} AS (SELECT DISTINCT tree, i, h FROM {name}{k})")
            sql.append(f"c{name}{k} AS (SELECT tree, count(*) AS n FROM n{name}{k} GROUP BY tree)")
            sql.append(f"r{name}{k} AS (SELECT tree, i // 16 AS p, list(h ORDER BY i) AS run FROM n{name}{k} GROUP BY tree, i // 16)")
            sql.append(f"""{name}{k + 1} AS (SELECT rid, x.tree, CASE WHEN n > 1 THEN p ELSE i END AS i, CASE WHEN n > 1 THEN sha256(array_to_string(run, '')) ELSE h END AS h,
    CASE WHEN n > 1 THEN proof || array_to_string(run[1:i % 16] || run[i % 16 + 2:], '') ELSE proof END AS proof,
    CASE WHEN n > 1 THEN sha256(array_to_string(run[1:i % 16] || [fold] || run[i % 16 + 2:], '')) ELSE fold END AS fold
    FROM {name}{k} x JOIN c{name}{k} c ON x.tree IS NOT DISTINCT FROM c.tree JOIN r{name}{k} r ON x.tree IS NOT DISTINCT FROM r.tree AND x.i // 16 = r.p)""")
        return f"{name}{levels}"

    low = climb("s", "s0")
    sql.append(f"o AS (SELECT tree AS source, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i FROM (SELECT DISTINCT tree FROM {low}))")
    sql.append(f"t0 AS (SELECT rid, 0 AS tree, o.i, h, proof, fold FROM {low} x JOIN o ON x.tree IS NOT DISTINCT FROM o.source)")
    top = climb("t", "t0")
    return f"""
WITH {', '.join(sql)}
SELECT doc_id, leaf, x.h AS subroot, y.h AS root, sha256(y.proof) AS proof_sha256, y.fold AS folded_root, y.fold = y.h AS verified
FROM l JOIN {low} x USING (rid) JOIN {top} y USING (rid)"""


ORACLE = {
    "op10_exact_dedup": r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents),
g AS (SELECT x, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256 FROM t JOIN g USING (x)""",
    "op2_quality_rules": rf"""
WITH words AS (SELECT doc_id, lang, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, coalesce(text, '') AS x,
    [l for l in string_split(coalesce(text, ''), chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines FROM documents),
grams AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM words, unnest(range(1, len(w) - 1)) AS u(i)),
twice AS (SELECT doc_id, g FROM grams GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM grams JOIN twice USING (doc_id, g), (VALUES (0), (1), (2)) AS s(d) GROUP BY doc_id),
m AS (SELECT words.doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, len(regexp_extract_all(x, '[#*$%&|<>]')) AS n_symbols,
    len(regexp_extract_all(x, '!')) AS n_bangs, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
    FROM words LEFT JOIN covered USING (doc_id)),
long AS (SELECT doc_id, lang, unnest([{{'rule': 'symbols', 'v': CASE WHEN n_words > 0 THEN n_symbols::DOUBLE / n_words ELSE 0 END}},
    {{'rule': 'long_words', 'v': CASE WHEN n_words > 0 THEN word_chars::DOUBLE / n_words ELSE 0 END}},
    {{'rule': 'dup_lines', 'v': CASE WHEN n_lines > 0 THEN n_dup_lines::DOUBLE / n_lines ELSE 0 END}},
    {{'rule': 'repeats', 'v': CASE WHEN n_words > 0 THEN n_repeat_words::DOUBLE / n_words ELSE 0 END}},
    {{'rule': 'bangs', 'v': CASE WHEN n_words > 0 THEN n_bangs::DOUBLE / n_words ELSE 0 END}}], recursive := true) FROM m),
grid AS (SELECT rule, unnest(cuts) AS cutoff FROM (VALUES {_RULES}) AS r(rule, cuts)),
l1 AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE quality IN (0, 1) GROUP BY doc_id HAVING min(quality) = max(quality)),
once AS (SELECT doc_id FROM documents GROUP BY doc_id HAVING count(*) = 1),
tried AS (SELECT lang, rule, cutoff, count(*) FILTER (quality = 1 AND v > cutoff) AS fr, count(*) FILTER (quality = 1) AS good,
    count(*) FILTER (quality = 0 AND v > cutoff) AS tr, count(*) FILTER (quality = 0) AS bad
    FROM long JOIN once USING (doc_id) JOIN l1 USING (doc_id) JOIN grid USING (rule) GROUP BY ALL),
tests AS (SELECT count(DISTINCT coalesce(lang, '')) * (SELECT count(*) FROM grid) AS n FROM tried),
terms AS (SELECT good, k, sum(exp(lgamma(good + 1) - lgamma(k + 1) - lgamma(good - k + 1) + k * ln({quality.RISK / len(quality.RULES)}) + (good - k) * ln(1 - {quality.RISK / len(quality.RULES)})))
    OVER (PARTITION BY good ORDER BY k) AS p FROM (SELECT DISTINCT good FROM tried WHERE good > 0) AS q, unnest(range(0, ceil(good * {quality.RISK / len(quality.RULES)})::BIGINT + 1)) AS u(k)),
may AS (SELECT good, max(k) AS allowed FROM terms, tests WHERE p <= {quality.DELTA} / tests.n GROUP BY good),
scored AS (SELECT lang, rule, cutoff, tr / greatest(bad, 1) - {quality.COST} * (fr / greatest(good, 1)) AS score FROM tried JOIN may USING (good) WHERE fr <= allowed),
chosen AS (SELECT lang, rule, arg_max(cutoff, (score, cutoff)) AS cutoff FROM scored WHERE score > 0 GROUP BY lang, rule),
hit AS (SELECT DISTINCT doc_id FROM long JOIN chosen ON long.rule = chosen.rule AND long.lang IS NOT DISTINCT FROM chosen.lang WHERE v > cutoff),
j AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND hit.doc_id IS NULL AS kept FROM j LEFT JOIN hit USING (doc_id)""",
    "op7_mixing": rf"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(doc_id::VARCHAR, '') || ':{mixing.SEED}') AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS idx FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(idx - 1) % 3 + 1] AS w, {mixing.MAX_EPOCHS} * source_size AS cap FROM s),
round(n, idx, full_) AS (
    SELECT 0, idx, false FROM w
    UNION ALL
    SELECT n + 1, r.idx, full_ OR w.w * ((SELECT sum(source_size) FROM w) - coalesce(sum(w.cap) FILTER (full_) OVER (), 0))::DOUBLE
        / (sum(w.w) FILTER (NOT full_) OVER ()) > w.cap FROM round r JOIN w USING (idx) WHERE n < 1 + (SELECT count(*) FROM w)),
last AS (SELECT idx, full_ FROM round WHERE n = (SELECT max(n) FROM round)),
t AS (SELECT w.*, CASE WHEN full_ THEN cap::DOUBLE ELSE w * (((SELECT sum(source_size) FROM w) - coalesce(sum(cap) FILTER (full_) OVER (), 0))::DOUBLE / (sum(w) FILTER (NOT full_) OVER ())) END AS target FROM w JOIN last USING (idx)),
q AS (SELECT d.doc_id, d.size, t.idx, t.source_size, t.target, sum(d.size) OVER (PARTITION BY t.idx ORDER BY d.key, d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS done FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
copies AS (SELECT doc_id, idx, size, e, done, (done + e * source_size)::DOUBLE / target AS finish FROM q, unnest(range(0, {mixing.MAX_EPOCHS})) AS u(e) WHERE size > 0 AND target > 0),
run AS (SELECT *, sum(size) OVER (ORDER BY finish, idx, e, done ROWS UNBOUNDED PRECEDING) AS total FROM copies),
taken AS (SELECT doc_id, idx, sum(size)::BIGINT AS taken FROM run WHERE total <= (SELECT sum(source_size) FROM w) GROUP BY doc_id, idx)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(taken.taken, 0) AS taken FROM q LEFT JOIN taken USING (doc_id, idx)""",
    "op8_line_dedup": r"""
WITH p AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)) AS host,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'),
        '[\x20\x09-\x0D]+', ' ', 'g'), '(?i)</?(?:LINE_TAGS)(?:[ /][^>]*)?>', chr(10), 'g'), '<[^>]*>', '', 'g') AS x FROM pages),
l AS (SELECT page_id, host, [trim(s) for s in string_split(regexp_replace(x, '[ \t]*\n[ \t\n]*', chr(10), 'g'), chr(10)) if s != ''] AS lines FROM p),
n AS (SELECT host, count(*) AS pages FROM l GROUP BY host),
c AS (SELECT host, line, count(*) AS k FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM l) GROUP BY host, line),
b AS (SELECT host, list(line) AS boiler FROM c JOIN n USING (host) WHERE k >= MIN_COPIES AND k > RATIO * pages GROUP BY host),
f AS (SELECT page_id, host, lines, [s for s in lines if NOT list_contains(coalesce(boiler, []), s)] AS kept FROM l LEFT JOIN b USING (host))
SELECT page_id, host, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped, coalesce(array_to_string(kept, chr(10)), '') AS text FROM f"""
    .replace("LINE_TAGS", site_lines.LINE_TAGS).replace("MIN_COPIES", str(site_lines.MIN_COPIES)).replace("RATIO", str(site_lines.RATIO)),
    "op11_hard_negatives": f"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, [floor({hard_negatives.SCALE} * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same, list_dot_product(a.v, o.v)::BIGINT AS score FROM e a JOIN e o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
    FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
    "op12_secret_scan": _secret_sql(),
    "op13_merkle_manifest": _merkle_sql(),
}
