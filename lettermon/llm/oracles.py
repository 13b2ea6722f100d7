"""DuckDB SQL of the registered queries that SQL can express.

License scan, HTML extraction, language ID, SimHash, BPE and sharding have
none (automata, learned weights, XXH64, a tokenizer, CRC32); they are tested
against brute force, held-out accuracy and the tokenizer library instead.
"""

from __future__ import annotations

from . import urls
from .queries import URL_RULES

_UP, _LOW = urls.UPPER, urls.LOWER
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _rule_case(column: str) -> str:
    """The longest rule that fits, as SQL."""
    rows = " UNION ALL ".join(f"SELECT '{r.host}' AS h, '{r.path}' AS p, '{r.verdict}' AS v" for r in URL_RULES)
    value = "h || p" if column == "rule" else "v"
    return (f"(SELECT {value} FROM ({rows}) WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) "
            f"ORDER BY length(h || p) DESC LIMIT 1)")


#: Any public suffix of several labels, as a pattern.
_SUFFIX = "(" + "|".join(s.replace(".", "[.]") for s in urls.PUBLIC_SUFFIXES) + ")"


def _site(listed: str, plain: str, address: str) -> str:
    """Part of a bare host: under a listed suffix, under any other, or of an IP address."""
    return f"CASE WHEN regexp_matches(bare, '{urls.IP_ADDRESS}') THEN {address} WHEN regexp_matches(bare, '(^|[.]){_SUFFIX}$') THEN {listed} ELSE {plain} END"


def _url_filter() -> str:
    def level(name, rows):
        return f"""
{name}_weight AS (
  SELECT CASE WHEN g > 1 AND total > g AND between_ + (usual - 1) * within_ > 0 THEN
           CASE WHEN between_ <= within_ THEN {urls.PRIOR_MOST} ELSE
             least(greatest((between_ + (usual - 1) * within_) / (between_ - within_) - 1, {urls.PRIOR_LEAST}),
                   {urls.PRIOR_MOST}) END
         ELSE {urls.PRIOR_UNKNOWN} END AS k
  FROM (SELECT g, total, (s - total * power(hits / total, 2)) / nullif(g - 1, 0) AS between_,
               (hits - s) / nullif(total - g, 0) AS within_,
               (total - squares / total) / nullif(g - 1, 0) AS usual
        FROM (SELECT count(*) AS g, CAST(sum(n) AS DOUBLE) AS total, CAST(sum(good) AS DOUBLE) AS hits,
                     CAST(sum(n * n) AS DOUBLE) AS squares, sum(good * (good / n)) AS s
              FROM {rows} WHERE n > 0)))"""
    return f"""
WITH sites AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{_UP}', '{_LOW}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
outcomes AS (
  SELECT host, CAST(quality = 1 AND toxic = 0 AS BIGINT) AS good FROM sites JOIN labels ON doc_id = page_id
  WHERE (quality = 1 AND toxic = 0) IS NOT NULL),
hosts AS (
  SELECT h.host, {_site("regexp_extract(bare, '" + _SUFFIX + "$')", "regexp_extract(bare, '[^.]*$')", repr(urls.IP_SUFFIX))} AS suffix,
         {_site("regexp_extract(bare, '([^.]*[.])?" + _SUFFIX + "$')", "regexp_extract(bare, '([^.]*[.])?[^.]*$')", "bare")} AS domain,
         count(good) AS n, CAST(coalesce(sum(good), 0) AS BIGINT) AS good
  FROM (SELECT DISTINCT host, regexp_replace(host, ':[0-9]*$', '') AS bare FROM sites) h
  LEFT JOIN outcomes o ON o.host = h.host GROUP BY h.host, bare),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY suffix, domain),
suffixes AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM domains GROUP BY suffix),
overall AS (SELECT coalesce(sum(good) / nullif(sum(n), 0), 0.5) AS p FROM suffixes),
{level("host", "hosts")},
{level("domain", "domains")},
{level("suffix", "suffixes")},
by_suffix AS (
  SELECT suffix, (good + k * p) / (n + k) AS p FROM suffixes, suffix_weight, overall),
by_domain AS (
  SELECT d.suffix, d.domain, (d.good + k * s.p) / (d.n + k) AS p
  FROM domains d JOIN by_suffix s ON s.suffix = d.suffix, domain_weight),
reputation AS (
  SELECT host AS site, n, good, greatest(m - 1.645 * sqrt(m * (1 - m) / (size + 1)), 0) AS bound
  FROM (SELECT h.host, h.n, h.good, h.n + k AS size, (h.good + k * d.p) / (h.n + k) AS m
        FROM hosts h JOIN by_domain d ON d.domain = h.domain AND d.suffix = h.suffix, host_weight))
SELECT page_id, host, path, {_rule_case("rule")} AS rule,
       coalesce({_rule_case("verdict")}, CASE WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END) AS verdict,
       n AS n_labels, good AS n_good, round(bound, 6) AS bound
FROM sites JOIN reputation ON site = host
"""


EXACT = r"""
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY p) AS group_size,
       row_number() OVER w = 1 AS kept, sha256(p) AS text_sha256
FROM (SELECT doc_id, length(coalesce(text, '')) AS n,
             regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS p FROM documents)
WINDOW w AS (PARTITION BY p ORDER BY n DESC, doc_id)
"""

DECONTAMINATION = rf"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '{_WORDS}') AS ws FROM benchmark),
item_grams AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS gram
  FROM (SELECT item_id, ws, least(5, len(ws)) AS k, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i
        FROM item_words WHERE len(ws) > 0)),
items AS (SELECT item_id, count(*) AS shingles FROM item_grams GROUP BY item_id),
doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '{_WORDS}') AS ws FROM documents),
doc_grams AS (
  SELECT DISTINCT doc_id, k, array_to_string(ws[i:i + k - 1], ' ') AS gram
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM doc_words, (SELECT DISTINCT k FROM item_grams) WHERE len(ws) >= k)),
shared AS (
  SELECT doc_id, item_id, count(*) AS shared FROM doc_grams JOIN item_grams USING (k, gram) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, shingles, shared / shingles AS containment
FROM shared JOIN items USING (item_id) WHERE shared >= greatest(1, ceil(0.8 * shingles - 1e-9))
"""

# Conversations of the tables hold no tool calls; linking and validation are tested on rows of their own.
CHATS = """
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS seq, turn, role,
       '{"content":' || CAST(to_json(text) AS VARCHAR) || ',"role":' || CAST(to_json(role) AS VARCHAR) || '}' AS json,
       CAST(0 AS BIGINT) AS n_calls, CAST(NULL AS VARCHAR) AS call_id, TRUE AS valid, '' AS errors
FROM conversations
"""

RANKED = rf"""
WITH doc_words AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '{_TERMS}')) AS term
  FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT d, doc_id, count(*) AS n FROM doc_words GROUP BY d, doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS len FROM sizes),
tfs AS (SELECT d, term, count(*) AS tf FROM doc_words GROUP BY d, term),
terms AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term),
items AS (SELECT DISTINCT item_id, text FROM benchmark),
item_terms AS (
  SELECT i, item_id, term, count(*) AS repeats
  FROM (SELECT row_number() OVER () AS i, item_id,
               unnest(regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '{_TERMS}')) AS term FROM items)
  GROUP BY i, item_id, term),
scores AS (
  SELECT i, item_id, d, doc_id,
         CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // len)))) AS BIGINT) AS score
  FROM item_terms JOIN terms USING (term) JOIN tfs USING (term) JOIN sizes USING (d), totals
  GROUP BY i, item_id, d, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""

PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[.,;:!?
-
]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM worded GROUP BY lang),
grams AS (
  SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i
  FROM worded, (VALUES (1), (2), (3), (4)) AS sizes(k) WHERE len(ws) >= k),
f AS (
  SELECT lang, k, phrase, count(*) AS a FROM (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase FROM grams)
  GROUP BY lang, k, phrase HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, l.a AS l, r.a AS r, c.cut,
         CAST(CAST(2000000 AS HUGEINT) * c.a // (l.a + r.a) AS BIGINT) AS score
  FROM (SELECT lang, phrase, a, k, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS cut FROM f WHERE k > 1) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:c.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, a, ws, k, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT lang, a, k, string_split(phrase, ' ') AS ws, unnest(range(2, k)) AS m FROM f WHERE k > 2))
  GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT w.*, t.n, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, CAST(encode(w.phrase) AS BLOB)) AS rank
      FROM weakest w JOIN totals t ON t.lang = w.lang
      LEFT JOIN inner_ i ON i.lang = w.lang AND i.phrase = w.phrase
      WHERE i.longer IS NULL OR CAST(100 AS HUGEINT) * i.longer < CAST(80 AS HUGEINT) * w.a)
WHERE rank <= 2000
"""


ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": _url_filter(),
    "op3_exact_dedup": EXACT,
    "op5_decontamination": DECONTAMINATION,
    "op9_chat_formatting": CHATS,
    "op11_ranked_search": RANKED,
    "op13_phrases": PHRASES,
}
