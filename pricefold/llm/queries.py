"""The registered queries of this subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricefold.llm import attention_lm, byte_bpe, chat_format, decontaminate, filter_audit, importance, language_id, ngram_join, quality_rules, quality_vote, reshard, training_order, url_filter
from pricefold.llm.common import new_path, stored, table

URL_RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
BPE_FILE = "byte_bpe_50k.tiktoken"
OLD_SHARDS = 16
TRAINING_KEY = b"epoch 1"


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed URLs: the canonical URLs of pages whose document (the number in the path) is labelled toxic."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.expr(r"try_cast(regexp_extract(url, '^[^?#]*/([0-9]+)(\\.html)?/?([?#]|$)', 1) AS bigint)")
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id")
    listed = pages.select(number.alias("doc_id"), url_filter.canonical_url(F.col("url")).alias("canonical")).join(toxic, "doc_id", "left_semi")
    return url_filter.judge_urls(pages, listed.select("canonical"), URL_RULES).drop("url")


OP1_SQL = r"""
WITH p AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
q AS (SELECT page_id, url,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)='))) AS kept,
    try_cast(regexp_extract(url, '^[^?#]*/([0-9]+)(\.html)?/?([?#]|$)', 1) AS BIGINT) AS n FROM p),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html|/)$', '')
    || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical FROM q),
l AS (SELECT DISTINCT canonical FROM c JOIN labels ON n = doc_id WHERE toxic = 1 AND canonical IS NOT NULL),
r AS (SELECT page_id, host, path, l.canonical IS NOT NULL AS listed,
    CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM c LEFT JOIN l USING (canonical))
SELECT page_id, host, path, rule,
    CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
         ELSE CASE WHEN listed THEN 'block' ELSE 'allow' END END AS verdict, listed FROM r
"""


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe, formatted by the standard template and read back."""
    return chat_format.digests(chat_format.format_conversations(chat_format.with_probe(table(spark, sf_dir, "conversations"))))


def op3_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as shards in training order; the rows are read back from the shards."""
    tokens = training_order.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)
    manifest = stored(training_order.write_shards(tokens, new_path(spark, "shards"), TRAINING_KEY), "manifest")
    return training_order.read_shards(spark, manifest.repartition("shard")).drop("ids")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaked benchmark item of every document."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document by the public rank file, as digests."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose shingle sets link."""
    return ngram_join.link_components(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, computed once and stored; cutoffs from all labelled ones; verdicts."""
    numbers = stored(quality_rules.with_statistics(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"), "rules")
    labelled = numbers.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    out = quality_rules.judge(numbers, quality_rules.calibrate(labelled))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")


def op7_sql() -> str:
    """The statistics from word lists and windows, the binomial tail as a sum of its terms."""
    q = quality_rules
    word, bands = r"[^\x20\x09-\x0D]", "".join(f"WHEN n_words < {b} THEN {i} " for i, b in enumerate(q.BANDS))
    count = lambda pattern: f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"
    share = lambda a, b: f"CASE WHEN {b} > 0 THEN ({a})::DOUBLE / {b} ELSE 0 END"
    ratios = {"symbols": share("n_symbols", "word_chars"), "marks": share(count("[!?]"), "word_chars"), "capitals": share(r"length(regexp_replace(t, '[^\p{Lu}]+', '', 'g'))", "word_chars"), "lines": share("n_dup_lines", "len(ls)"), "repeats": share("n_repeat_words", "n_words")}
    part, level = q.RISK / len(q.RULES), q.DELTA / ((len(q.BANDS) + 1) * len(q.RULES))
    return rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}+') AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls FROM documents),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS three, unnest(range(1, len(ws) - 1)) AS i FROM w),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, three) AS c FROM g), (SELECT unnest([0, 1, 2]) AS k) WHERE c > 1 GROUP BY doc_id),
a AS (SELECT w.*, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars, ({count("[" + q.SYMBOLS + "]")})::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed, CASE {bands}ELSE {len(q.BANDS)} END AS stratum, {", ".join(f"{v} AS r_{k}" for k, v in ratios.items())} FROM a),
good AS (SELECT stratum, unnest([{", ".join(f"{{'rule': '{k}', 'v': r_{k}}}" for k in q.RULES)}]) AS x FROM b JOIN labels USING (doc_id) WHERE quality = 1 AND NOT base_failed),
tried AS (SELECT stratum, x.rule AS rule, cut, count(*) AS n, count(CASE WHEN x.v > cut THEN 1 END) AS k FROM good, (SELECT unnest([{", ".join(f"{c}::DOUBLE" for c in q.GRID)}]) AS cut) GROUP BY ALL),
tail AS (SELECT *, list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - CASE WHEN i < n THEN lgamma(n - i + 1) ELSE 0 END + i * ln({part}::DOUBLE) + (n - i) * ln(1 - {part}::DOUBLE)))) AS p FROM tried),
cuts AS (SELECT stratum, {", ".join(f"min(cut) FILTER (rule = '{k}') AS cut_{k}" for k in q.RULES)} FROM tail WHERE p <= {level}::DOUBLE GROUP BY stratum),
j AS (SELECT b.*, CASE {" ".join(f"WHEN r_{k} > cut_{k} THEN '{k}'" for k in q.RULES)} END AS rejected_by FROM b LEFT JOIN cuts USING (stratum))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rejected_by IS NULL AS kept, rejected_by FROM j
"""


def op8_quality_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by its nearest labelled neighbours."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    voters = quality_vote.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return quality_vote.with_score(docs, voters).drop("text")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.with_language(docs.select("doc_id", "text"), language_id.fit(docs)).drop("text")


def op10_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 16 shards by source, of which one is far too large, to 24 of equal bytes; the rows are read back from the rewritten shards."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return reshard.resharded(docs, F.crc32(F.col("source")) % OLD_SHARDS)


def op11_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log10 probability by the self-attention model and by the unigram base."""
    return attention_lm.scored(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(BPE_FILE))


def op12_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the benchmark's words."""
    docs, target = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")
    return importance.resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


#: crc32 is a fold over a word's bytes with a table of 256 remainders, made by the polynomial's rule.
OP12_SQL = r"""
WITH tab AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t FROM (SELECT unnest(range(256)) AS i)),
src AS (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT kind, id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM src),
n AS (SELECT kind, id, word, count(*) AS n FROM w GROUP BY ALL),
u AS (SELECT word, hex(encode(word)) AS x FROM (SELECT DISTINCT word FROM n)),
b AS (SELECT word, list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)) AS bytes FROM u),
h AS (SELECT word, xor(list_reduce(bytes, lambda c, y: xor(c // 256, t[xor(c % 256, y) + 1])), 4294967295) % 10000 AS bucket FROM b, tab),
k AS (SELECT bucket, sum(n) FILTER (kind = 0) AS s, sum(n) FILTER (kind = 1) AS t FROM n JOIN h USING (word) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE) / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(sum(t) OVER (), 0) + 10000)::DOUBLE)))::BIGINT AS gain FROM k),
d AS (SELECT id AS doc_id, sum(n) AS f, sum(n * gain) AS w FROM n JOIN h USING (word) JOIN g USING (bucket) WHERE kind = 0 GROUP BY id),
a AS (SELECT doc_id, coalesce(f, 0)::BIGINT AS n_features, coalesce(w, 0)::BIGINT AS weight, coalesce(w, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM documents LEFT JOIN d USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS many FROM a WHERE n_features >= 20)
SELECT a.*, rank FROM a LEFT JOIN r ON a.doc_id = r.doc_id AND rank <= 10 * many // 100
"""


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, by language."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels")
    return filter_audit.audited(filter_audit.mask_counts(docs, labels))


OP13_SQL = r"""
WITH l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, coalesce(good, 0) AS good, coalesce(l.toxic, 0) AS toxic FROM documents LEFT JOIN l USING (doc_id)),
f AS (SELECT part, good, toxic, [CASE WHEN len(ws) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' END, CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t) THEN 'C' END, CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END] AS fails FROM d),
m AS (SELECT part, array_to_string(list_filter(fails, lambda x: x IS NOT NULL), '') AS fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(string_split('ABCDE', '')) AS c),
o AS (SELECT a.c || b.c || p.c || q.c || e.c AS filter_order FROM x a, x b, x p, x q, x e WHERE len(list_distinct([a.c, b.c, p.c, q.c, e.c])) = 5),
s AS (SELECT filter_order, i AS step, filter_order[i:i] AS c, filter_order[1:i - 1] AS before FROM o, (SELECT unnest(range(1, 6))::INT AS i)),
y AS (SELECT part, filter_order, step, c, contains(fails, c) AS now, length(translate(fails, before, '')) < length(fails) AS gone, fails = c AS alone, n, good, toxic FROM m, s),
z AS (SELECT part, filter_order, step, c, sum(CASE WHEN NOT gone AND NOT now THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN NOT gone AND now THEN n ELSE 0 END)::BIGINT AS removed, sum(CASE WHEN gone AND now THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails, sum(CASE WHEN NOT gone AND now THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN NOT gone AND now THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM y GROUP BY ALL)
SELECT * EXCLUDE (c), (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley FROM z
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_chat_format": op2_chat_format,
    "op3_training_order": op3_training_order,
    "op4_decontaminate": op4_decontaminate,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_ngram_join": op6_ngram_join,
    "op7_quality_rules": op7_quality_rules,
    "op8_quality_vote": op8_quality_vote,
    "op9_language_id": op9_language_id,
    "op10_reshard": op10_reshard,
    "op11_attention_lm": op11_attention_lm,
    "op12_importance_resample": op12_importance_resample,
    "op13_filter_audit": op13_filter_audit,
}
SQL: dict[str, str] = {"op1_url_filter": OP1_SQL, "op7_quality_rules": op7_sql(), "op12_importance_resample": OP12_SQL, "op13_filter_audit": OP13_SQL}
