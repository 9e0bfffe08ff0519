"""The registered queries of the operators, and the SQL that states their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import language_id, toxicity
from quadrille.llm._sampling import in_fold
from quadrille.llm._store import Scratch
from quadrille.llm.decontaminate import LEAST_SHARE, find_overlaps
from quadrille.llm.exact_dedup import mark_exact_duplicates
from quadrille.llm.katz import score_katz
from quadrille.llm.line_dedup import mark_common_lines
from quadrille.llm.ngram_join import link_components
from quadrille.llm.prefix_trie import build_trie, end_hashes, ordered_turns, shared_starts
from quadrille.llm.resampling import resample
from quadrille.llm.secret_scan import BASE_RULES, Rule, scan_secrets, span_text
from quadrille.llm.secret_scan import RULES as ALL_RULES
from quadrille.llm.source_mix import mix_sources
from quadrille.llm.token_files import ID_DIGITS, count_tokens, told_id, write_word_ids
from quadrille.llm.url_filter import RULES, filter_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


OP1_SQL = r"""
WITH RECURSIVE
w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
p AS (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS p FROM w WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, least(p + 4, len(w))), ' ') AS s FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m FROM s AS a JOIN s AS b USING (s) GROUP BY ALL
),
link AS (
  SELECT x, y FROM met JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y
  WHERE x <> y AND 100 * m >= 75 * (nx.n + ny.n - m)
),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reach.y) AS component_id
FROM documents AS d JOIN reach ON reach.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
GROUP BY d.doc_id
"""


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    models = language_id.fit_on(docs.where(F.col("doc_id").isNotNull() & ~in_fold(F.col("doc_id"), 4, 2)))
    found = language_id.identify(docs, models)
    return found.select("doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_exact_duplicates(_table(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept,
       text_sha256
FROM d
"""


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Fitted on the labelled ones of ``docs`` outside the held-out fold."""
    labels = _table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & ~in_fold(F.col("doc_id"), 5, 0))
    return toxicity.fit_on(docs, labels)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = toxicity.score_toxicity(docs, toxicity_model(spark, docs, sf_dir))
    return found.select("doc_id", in_fold(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = in_fold(F.col("doc_id"), 7, 2)
    found = score_katz(_table(spark, sf_dir, "documents"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "tokens")
    write_word_ids(_table(spark, sf_dir, "documents"), scratch.path("ids"))
    found = count_tokens(spark, scratch.path("ids"), header=ID_DIGITS, one_stream=True)
    scratch.drop("ids")  # their pieces are written by now
    return found.select(told_id().alias("doc_id"), (F.col("n_tokens") - ID_DIGITS).alias("n_tokens"))


OP6_SQL = r"""
SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
FROM documents
"""


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    part, whole = LEAST_SHARE
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * whole >= F.col("n_words") * part)).alias("contaminated"),
    )


OP7_SQL = r"""
WITH
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
iw AS (
  SELECT item_id, w, least(13, len(w)) AS size, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p FROM i WHERE len(w) > 0
),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(w, p, p + size - 1), ' ') AS words FROM iw
),
sizes AS (SELECT DISTINCT size FROM item_windows),
dw AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, sizes WHERE len(w) >= size
),
doc_windows AS (
  SELECT doc_id, p, size, array_to_string(list_slice(w, p, p + size - 1), ' ') AS words FROM dw
),
found AS (
  SELECT doc_id, p, size, item_id FROM doc_windows JOIN item_windows USING (size, words)
),
hits AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM found) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id,
       CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN items ON d.doc_id = items.doc_id
"""


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


_PARTS = """CASE WHEN strpos({url}, '://') > 0 THEN substr({url}, strpos({url}, '://') + 3) ELSE '' END"""
_HOST = "translate(regexp_extract({rest}, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"
_RULE_ROWS = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in RULES)



def _address(url: str, rest: str) -> str:
    """Host, path (the root if left out) and query."""
    path = _PATH.format(rest=rest)
    return f"{_HOST.format(rest=rest)} || CASE WHEN {path} = '' THEN '/' ELSE {path} END || regexp_extract({rest}, '^[^?#]*(\\?[^#]*)', 1)"


def _undotted(path: str) -> str:
    """A path that begins with a slash without its segments . and .. , which leave a slash at the end."""
    parts = f"string_split({path}, '/')"
    fold = f"""list_reduce({parts}, lambda kept, x : CASE WHEN x = '..' THEN regexp_replace(kept, '/[^/]*$', '') WHEN x = '.' THEN kept ELSE kept || '/' || x END)"""
    return f"{fold} || CASE WHEN {parts}[-1] IN ('.', '..') THEN '/' ELSE '' END"


def _resolved(base: str, to: str) -> str:
    rest = _PARTS.format(url=base)
    site, path = f"regexp_extract({base}, '^.*?://[^/?#]*')", _PATH.format(rest=f"({rest})")
    place, after = f"regexp_extract({to}, '^[^?#]*')", f"regexp_extract({to}, '^[^?#]*(.*)$', 1)"
    folder = f"CASE WHEN {path} = '' THEN '/' ELSE regexp_extract({path}, '^.*/') END"
    return f"""(CASE
    WHEN starts_with({to}, '//') THEN split_part({base}, '://', 1) || ':' || {to}
    WHEN starts_with({to}, '/') THEN {site} || {_undotted(place)} || {after}
    WHEN regexp_matches({to}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {to}
    WHEN starts_with({to}, '?') THEN {site} || {path} || {to}
    WHEN starts_with({to}, '#') THEN {site} || {path} || regexp_extract(({rest}), '^[^?#]*(\\?[^#]*)', 1) || {to}
    ELSE {site} || {_undotted(f"({folder} || {place})")} || {after} END)"""


OP8_SQL = rf"""
WITH RECURSIVE
rules(verdict, site, under) AS (VALUES {_RULE_ROWS}),
p AS (SELECT row_number() OVER () AS n, page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, {_PARTS.format(url="coalesce(url, '')")} AS rest FROM pages),
named AS (SELECT n, page_id, url, html, rest, {_HOST.format(rest="rest")} AS host, {_PATH.format(rest="rest")} AS path FROM p),
tags AS (SELECT url, html, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\b[^>]*>')) AS t FROM named WHERE host <> ''),
links AS (
  SELECT url, replace(regexp_extract(regexp_extract(html, '(?i)<base\b[^>]*\bhref\s*=\s*["'']?\s*[^"''\s>][^>]*>'), '(?i)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1), '&amp;', '&') AS base,
    replace(CASE
    WHEN regexp_matches(t, '(?i)^<link\b[^>]*\brel\s*=\s*["'']?canonical\b') THEN regexp_extract(t, '(?i)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1)
    WHEN regexp_matches(t, '(?i)^<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b') THEN regexp_extract(t, '(?i)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1)
    ELSE '' END, '&amp;', '&') AS t FROM tags
),
based AS (SELECT url, CASE WHEN base = '' THEN url ELSE {_resolved("url", "base")} END AS base, t FROM links WHERE t <> ''),
joined AS (SELECT url AS f, {_resolved("base", "t")} AS t FROM based),
sides AS (SELECT f, t, {_PARTS.format(url="f")} AS f_rest, {_PARTS.format(url="t")} AS t_rest FROM joined),
edges AS (
  SELECT {_address("f", "f_rest")} AS a, {_address("t", "t_rest")} AS b, {_HOST.format(rest="f_rest")} AS a_host, {_PATH.format(rest="f_rest")} AS a_path,
         {_HOST.format(rest="t_rest")} AS b_host, {_PATH.format(rest="t_rest")} AS b_path
  FROM sides
  WHERE {_HOST.format(rest="f_rest")} <> '' AND {_HOST.format(rest="t_rest")} <> ''
),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
addresses AS (SELECT a, a_host AS host, a_path AS path FROM edges UNION SELECT b, b_host, b_path FROM edges),
decided AS (
  SELECT host, path, arg_max(verdict, length(site || under)) AS verdict, arg_max(site || under, length(site || under)) AS rule
  FROM (SELECT host, path FROM named UNION SELECT host, path FROM addresses)
  JOIN rules ON (host = site OR suffix(host, '.' || site)) AND starts_with(path, under) GROUP BY host, path
),
reach AS (SELECT a, a AS b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
spread AS (
  SELECT reach.a FROM reach JOIN addresses ON addresses.a = reach.b JOIN decided USING (host, path)
  GROUP BY reach.a HAVING bool_or(verdict = 'block') AND NOT bool_or(verdict = 'allow')
)
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN host <> '' AND {_address("url", "rest")} IN (SELECT a FROM spread) THEN 'block' ELSE 'allow' END) AS verdict
FROM named LEFT JOIN decided USING (host, path)
"""


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mix_sources(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def _of_kinds(kinds: list[str]) -> Column:
    return F.filter("spans", lambda s: s["kind"].isin(kinds))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = scan_secrets(_table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in BASE_RULES]
    return findings.select(
        "doc_id",
        *[F.size(_of_kinds([k])).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(span_text(_of_kinds(kinds)), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def _span_rows(number: int, rule: Rule) -> str:
    """Spans of one rule: the pieces between matches and the matches before add up to each start."""
    pattern = rule.pattern.replace("'", "''")
    before = lambda of, upto: f"coalesce(list_sum(list_transform(list_slice({of}, 1, {upto}), lambda x: length(x))), 0)"
    return f"""m{number} AS (
  SELECT doc_id, regexp_split_to_array(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS found,
         regexp_extract_all(t, '{pattern}', {rule.group}) AS held
  FROM d WHERE regexp_matches(t, '{pattern}')
),
i{number} AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m{number}),
s{number} AS (
  SELECT doc_id, {number} AS rank, '{rule.kind}' AS kind, CAST({before("gaps", "i")} + {before("found", "i - 1")} AS BIGINT) AS start,
         CAST({before("gaps", "i")} + {before("found", "i")} AS BIGINT) AS stop
  FROM i{number} WHERE length(held[i]) >= {rule.least}
)"""


_SPANS = "string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank)"
OP10_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{", ".join(_span_rows(n, r) for n, r in enumerate(ALL_RULES))},
spans AS ({" UNION ALL ".join(f"SELECT * FROM s{n}" for n, _ in enumerate(ALL_RULES))}),
grouped AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE_RULES)},
         {_SPANS} FILTER (rank < {len(BASE_RULES)}) AS base, {_SPANS} AS spans
  FROM spans GROUP BY doc_id
)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN grouped ON grouped.doc_id = d.doc_id
"""


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mark_common_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_KEY = _LOWER.format(text=r"trim(line, E' \t\n\x0B\x0C\r')")
OP11_SQL = rf"""
WITH
d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT r, doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM d),
k AS (SELECT r, doc_id, i, line, {_KEY} AS key FROM x),
common AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (common.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN common ON common.key = k.key GROUP BY r
"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "turns")
    turns = scratch.save(ordered_turns(_table(spark, sf_dir, "conversations")), "turns")
    trie = build_trie(shared_starts(turns))
    empty = F.sha2(F.lit(""), 256)
    return trie.nodes.join(end_hashes(trie.ends), "digest", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", empty).alias("ends_sha256")
    )


#: The unsigned crc32 of a list of bytes: eight shifts for each entry of the table, one look at it for each byte.
_CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, step : CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS crc FROM range(256) AS t(b)
)"""


def _crc(octets: str) -> str:
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, b : xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295)"


OP12_SQL = f"""
WITH
{_CRC_TABLE},
ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
taken AS (SELECT c, c - c % 5 AS start, {_crc("list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x : CAST(ascii(x) AS BIGINT))")} % 9 AS h FROM ids, crc_table),
said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id AS c, strlen(text) AS bytes, strlen(role) || ':' || strlen(text) || ':' || role || text AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(role) || ':' || role || text)) AS pos
  FROM said
),
rows AS (
  SELECT taken.c, 0 AS pos, 0 AS bytes, '' AS said FROM taken
  UNION ALL SELECT taken.c, pos, bytes, said FROM taken JOIN turns ON turns.c = taken.start AND pos <= h
  UNION ALL SELECT taken.c, pos, bytes, said FROM taken JOIN turns ON turns.c = taken.c AND pos > h
),
paths AS (
  SELECT c, bytes, row_number() OVER w - 1 AS depth, count(*) OVER (PARTITION BY c) - 1 AS n, string_agg(said, '') OVER w AS key
  FROM rows WINDOW w AS (PARTITION BY c ORDER BY pos ROWS UNBOUNDED PRECEDING)
),
linked AS (SELECT *, lag(key) OVER (PARTITION BY c ORDER BY depth) AS up FROM paths),
nodes AS (
  SELECT key, depth, any_value(up) AS up, any_value(bytes) AS bytes, min(c) AS c, count(*) AS n_convs,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (depth = n), '') AS ends
  FROM linked GROUP BY key, depth
),
children AS (SELECT up AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up),
counted AS (SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children ON children.key = nodes.key),
sums AS (
  SELECT above.key, above.depth, count(*) FILTER (below.n_children = 0) AS n_leaves, sum((below.n_convs - 1) * below.bytes) AS saved
  FROM counted AS below JOIN paths AS above ON above.c = below.c AND above.depth <= below.depth GROUP BY above.key, above.depth
)
SELECT counted.c AS conv_id, counted.depth, parent.c AS parent_conv_id, counted.n_convs, counted.n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(counted.ends) AS ends_sha256
FROM counted JOIN sums ON sums.key = counted.key AND sums.depth = counted.depth
LEFT JOIN counted AS parent ON parent.key = counted.up AND parent.depth = counted.depth - 1
"""


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


_OCTETS = "list_transform(range(0, strlen(f)), lambda i : CAST(('0x' || substr(hex(encode(f)), 2 * i + 1, 2)) AS BIGINT))"
OP13_SQL = rf"""
WITH
{_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER.format(text="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS r, regexp_extract_all({_LOWER.format(text="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
runs AS (
  SELECT true AS own, r, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))], [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])) AS f FROM d
  UNION ALL
  SELECT false, r, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] for i in range(1, len(w))], [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])) FROM b
),
named AS (SELECT f, {_crc(_OCTETS)} % 10000 AS bucket FROM (SELECT DISTINCT f FROM runs), crc_table),
counts AS (SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM runs JOIN named USING (f) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM counts
),
weights AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight, count(*) AS n_features FROM runs JOIN named USING (f) JOIN gains USING (bucket) WHERE own GROUP BY r),
scored AS (
  SELECT d.r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights ON weights.r = d.r
),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, weight DESC) AS rank FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= (SELECT 5 * count(*) // 100 FROM scored WHERE n_words >= 20) THEN rank END AS rank
FROM scored LEFT JOIN ranked ON ranked.r = scored.r
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_language_id": op2_language_id,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_katz": op5_katz,
    "op6_token_counts": op6_token_counts,
    "op7_decontaminate": op7_decontaminate,
    "op8_url_filter": op8_url_filter,
    "op9_source_mix": op9_source_mix,
    "op10_secret_scan": op10_secret_scan,
    "op11_line_dedup": op11_line_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_resampling": op13_resampling,
}
ORACLE_SQL: dict[str, str] = {
    "op1_ngram_join": OP1_SQL,
    "op3_exact_dedup": OP3_SQL,
    "op6_token_counts": OP6_SQL,
    "op7_decontaminate": OP7_SQL,
    "op8_url_filter": OP8_SQL,
    "op10_secret_scan": OP10_SQL,
    "op11_line_dedup": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_resampling": OP13_SQL,
}
