"""Queries of the corpus operators, by name, and SQL for those that it can express."""

from __future__ import annotations

from . import license_scan
from .alignment import op11_token_alignment
from .ann import op4_cross_polytope_ann
from .compression_quality import op10_compression_quality
from .conversation_trie import op13_conversation_trie
from .html_text import op2_html_main_text
from .language_model import op12_context_mixing
from .license_scan import op5_license_scan
from .line_dedup import op8_line_dedup
from .packing import op9_packing
from .pieces import op3_sentencepiece
from .quality_rules import op6_quality_rules
from .simhash import op7_simhash
from .toxicity import op1_toxicity

QUERIES = {
    f.__name__: f
    for f in (op1_toxicity, op2_html_main_text, op3_sentencepiece, op4_cross_polytope_ann, op5_license_scan, op6_quality_rules, op7_simhash, op8_line_dedup, op9_packing, op10_compression_quality, op11_token_alignment, op12_context_mixing, op13_conversation_trie)
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: The rules' shares as integer bins, with the lower and upper quantiles in percent and the multiple of each.
_QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
g AS (SELECT r, i, concat_ws(chr(1), w[i], w[i + 1], w[i + 2]) AS gram FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
rep AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) AS t(o) GROUP BY r),
m AS (SELECT d.r, doc_id, lang, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l, coalesce(rep.n, 0) AS n_repeat_words FROM d LEFT JOIN rep USING (r)),
b AS (SELECT *, len(l) - len(list_distinct(l)) AS n_dup_lines, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
bins AS (SELECT r, lang, source, base_failed, x.rule, x.bin, x.lo, x.hi, x.times FROM (SELECT *, unnest([
  {{'rule': 'symbols', 'bin': least(1000, 1000 * n_symbols // greatest(word_chars, 1)), 'lo': 0, 'hi': 90, 'times': 3}},
  {{'rule': 'dup_lines', 'bin': 1000 * n_dup_lines // greatest(len(l), 1), 'lo': 0, 'hi': 99, 'times': 1}},
  {{'rule': 'repeats', 'bin': 1000 * n_repeat_words // greatest(n_words, 1), 'lo': 0, 'hi': 99, 'times': 1}},
  {{'rule': 'word_length', 'bin': least(1000, 20 * word_chars // greatest(n_words, 1)), 'lo': 5, 'hi': 90, 'times': 3}}]) AS x FROM b)),
s AS (SELECT rule, lang, source, CASE WHEN grouping(lang) = 1 THEN 3 WHEN grouping(source) = 1 THEN 2 ELSE 1 END AS level, count(*) AS n, any_value(lo) AS lo, any_value(hi) AS hi, any_value(times) AS times,
  list_sort(list(bin)) AS a FROM bins WHERE NOT base_failed GROUP BY GROUPING SETS ((rule, lang, source), (rule, lang), (rule))),
q AS (SELECT *, a[greatest((lo * n + 99) // 100, 1)] AS lower, a[(50 * n + 99) // 100] AS middle, a[(hi * n + 99) // 100] AS upper FROM s),
lim AS (SELECT *, CASE WHEN lo > 0 THEN lower - times * greatest(middle - lower, 1) ELSE -1 END AS low, upper + times * greatest(upper - middle, 1) AS high FROM q),
f AS (SELECT bins.r, bins.rule, bin, arg_min(low, CASE WHEN lim.n >= 100 OR level = 3 THEN level ELSE 9 END) AS low, arg_min(high, CASE WHEN lim.n >= 100 OR level = 3 THEN level ELSE 9 END) AS high
  FROM bins JOIN lim ON lim.rule = bins.rule AND (level = 3 OR lim.lang IS NOT DISTINCT FROM bins.lang AND (level = 2 OR lim.source IS NOT DISTINCT FROM bins.source)) GROUP BY ALL),
v AS (SELECT r, string_agg(rule, ',' ORDER BY CASE rule WHEN 'symbols' THEN 1 WHEN 'dup_lines' THEN 2 WHEN 'repeats' THEN 3 ELSE 4 END) AS failed FROM f WHERE bin > high OR bin < low GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND failed IS NULL AS kept, coalesce(failed, '') AS failed FROM b LEFT JOIN v USING (r)
"""

_LINES = """
WITH l AS (SELECT doc_id, unnest(range(len(a))) AS n, unnest(a) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT doc_id, n, norm, string_split(norm, ' ') AS w FROM (SELECT doc_id, n, trim(regexp_replace(lower(line), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS norm FROM l) WHERE norm <> ''),
e AS (SELECT norm, any_value(w) AS w, min({'d': doc_id, 'n': n}) AS p FROM k GROUP BY norm),
c AS (SELECT norm, w, p FROM e WHERE len(w) >= 8),
v AS (SELECT p, len(w) AS words, i, array_to_string(list_concat(w[:i - 1], w[i + 1:]), ' ') AS variant FROM (SELECT p, w, unnest(range(1, len(w) + 1)) AS i FROM c)),
replaced AS (SELECT p, m AS o FROM (SELECT p, min(p) OVER (PARTITION BY variant, words, i) AS m FROM v) WHERE m < p),
longer AS (SELECT v.p, c.p AS o FROM v JOIN c ON c.norm = v.variant WHERE c.p < v.p),
shorter AS (SELECT c.p, v.p AS o FROM v JOIN c ON c.norm = v.variant WHERE v.p < c.p),
near AS (SELECT p, min(o) AS o FROM (SELECT * FROM replaced UNION ALL SELECT * FROM longer UNION ALL SELECT * FROM shorter) GROUP BY p),
f AS (SELECT k.doc_id, k.n, e.p, least(e.p, near.o) AS o, near.o AS q FROM k JOIN e USING (norm) LEFT JOIN near ON near.p = e.p)
SELECT doc_id, CAST(n AS INTEGER) AS line_no, coalesce(o, p).d AS kept_doc_id, CAST(coalesce(o, p).n AS INTEGER) AS kept_line_no FROM f WHERE p < {'d': doc_id, 'n': n} OR q IS NOT NULL
"""

_TRIE = r"""
WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS i FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(sha256(role || chr(0) || text) ORDER BY i) AS turns FROM t GROUP BY conv_id),
words AS (SELECT DISTINCT sha256(role || chr(0) || text) AS turn, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM t),
h AS (SELECT conv_id, turns, xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1])), 4294967295) % 4 AS h FROM own, tab),
full_ AS (SELECT h.conv_id, list_concat(coalesce(b.turns, [])[:h], h.turns[h + 1:]) AS turns FROM h LEFT JOIN own AS b ON b.conv_id = h.conv_id - h.conv_id % 20),
path AS (SELECT conv_id, d AS depth, array_to_string(turns[:d], ',') AS node, CASE WHEN d > 0 THEN array_to_string(turns[:d - 1], ',') END AS parent, turns[d] AS turn, d = len(turns) AS last FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM full_)),
n AS (SELECT node, any_value(depth) AS depth, any_value(parent) AS parent, any_value(turn) AS turn, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE last), '') AS ends FROM path GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
s AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(words, 0) AS own FROM n LEFT JOIN kids USING (node) LEFT JOIN words USING (turn)),
sub AS (SELECT p.node, sum(s.own) AS saved_tokens, count(*) FILTER (WHERE s.n_children = 0) AS n_leaves FROM s JOIN path AS p ON p.conv_id = s.conv_id AND p.depth <= s.depth GROUP BY p.node)
SELECT s.conv_id, s.depth, up.conv_id AS parent_conv_id, s.n_convs, s.n_children, sub.n_leaves, CAST(sub.saved_tokens AS BIGINT) AS saved_tokens, sha256(s.ends) AS ends_sha256
FROM s JOIN sub USING (node) LEFT JOIN n AS up ON up.node = s.parent
"""



def _license_sql() -> str:
    """The scan over words that each stand between spaces of their own, so that patterns need no look-around."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    wide = lambda pattern: pattern.removeprefix("(?<= )").removesuffix("(?= )").replace(" ", "  ")
    rules = ", ".join(f"({n}, {quoted(label)}, {prio}, {conf}, {quoted(keyword)}, {quoted(f' {wide(pattern)} ')})" for n, label, prio, conf, keyword, pattern in license_scan.rules())
    phrases = ", ".join(f"({quoted(label)}, {phrase.split()!r})" for phrase, label in license_scan.PHRASES.items())
    return f"""
WITH rules(id, label, prio, conf, kw, re) AS (VALUES {rules}),
phrases(label, p) AS (VALUES {phrases}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
base AS (SELECT r, label, unnest(list_filter(range(1, len(w) - len(p) + 2), lambda i: w[i:i + len(p) - 1] = p)) - 1 AS place FROM d, phrases),
b AS (SELECT r, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS labels FROM base GROUP BY r),
t AS (SELECT r, ' ' || array_to_string(w, ' ') || ' ' AS one, ' ' || array_to_string(w, '  ') || ' ' AS two FROM d),
m AS (SELECT r, id, label, prio, conf, regexp_extract_all(two, re) AS hits, string_split_regex(two, re) AS rest FROM t JOIN rules ON contains(one, kw)),
i AS (SELECT *, unnest(range(1, len(hits) + 1)) AS k FROM m),
f AS (SELECT r, id, label, prio, conf, list_sum(list_transform(rest[:k], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:k - 1], lambda x: length(x))), 0) AS s, length(hits[k]) AS n FROM i),
kept AS (SELECT * FROM f AS x WHERE NOT EXISTS (SELECT 1 FROM f AS y WHERE y.r = x.r AND y.s <= x.s AND y.s + y.n >= x.s + x.n AND y.prio <= x.prio AND (y.s < x.s OR y.n > x.n OR (y.prio, y.id) < (x.prio, x.id)))),
g AS (SELECT r, list(label) AS labels, max(conf) AS conf FROM kept GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(b.n, 0) AS n_base, b.lo AS first_word, b.hi AS last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(g.labels, [])))), ','), '') AS labels,
  greatest(coalesce(CAST(g.conf AS DOUBLE), 0.0), CASE WHEN b.n > 0 THEN 0.9 ELSE 0.0 END) AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN g USING (r)
"""


ORACLES: dict[str, str] = {"op5_license_scan": _license_sql(), "op6_quality_rules": _QUALITY, "op8_line_dedup": _LINES, "op13_conversation_trie": _TRIE}
