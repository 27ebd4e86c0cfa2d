"""DuckDB SQL for the dealt queries that SQL can express, written from their definitions alone."""

from __future__ import annotations

from .license_scan import NO_WORD, PHRASES, TEMPLATES, longest, token_set
from .quality_rules import CLASSES, Divergence

ORACLE: dict[str, str] = {}

_FIVE_WORD_SHINGLES = r"""
words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
           lambda w: w <> '') AS w
  FROM texts WHERE text IS NOT NULL),
shingles AS (
  SELECT DISTINCT kind, id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
         ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT kind, id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0))
"""

ORACLE["op4_decontamination"] = f"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
{_FIVE_WORD_SHINGLES},
sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 'b' GROUP BY id)
SELECT d.id AS doc_id, b.id AS item_id, any_value(sizes.n) AS item_shingles, count(*) AS common_shingles
FROM shingles d JOIN shingles b ON d.s = b.s AND d.kind = 'd' AND b.kind = 'b' JOIN sizes ON sizes.id = b.id
GROUP BY d.id, b.id HAVING 100 * count(*) >= 80 * any_value(sizes.n)
"""


def _quality_sql(rules: Divergence) -> str:
    """The base counts, every language's histograms over its documents, and the verdict, all from the texts."""
    strip = "text"
    lefts = ["text"]
    for c in CLASSES:
        strip = f"regexp_replace({strip}, '{c.replace(chr(39), chr(39) * 2)}', '', 'g')"
        lefts.append(strip)
    chars = [f"length({a}) - length({b}) AS c{k}" for k, (a, b) in enumerate(zip(lefts, lefts[1:]))]
    chars.append(f"length({lefts[-1]}) AS c{len(CLASSES)}")
    n_classes = len(CLASSES) + 1

    def term(p, q):
        return (f"CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {q}) / 2)) ELSE 0 END"
                f" + CASE WHEN {q} > 0 THEN {q} * log2({q} / (({p} + {q}) / 2)) ELSE 0 END")

    total = " + ".join(f"r.c{k}" for k in range(n_classes))
    by_char = " + ".join(term(f"(1.0 * d.c{k} / d.total_chars)", f"(1.0 * r.c{k} / ({total}))") for k in range(n_classes))
    return f"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i:i + 2] AS g FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs)),
again AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang, text, len(words) AS n_words, length(text) AS total_chars,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
         {", ".join(chars)}
  FROM docs),
refs AS (
  SELECT lang, sum(n_words) AS n_words, {", ".join(f"sum(c{k}) AS c{k}" for k in range(n_classes))}
  FROM counted WHERE lang IS NOT NULL GROUP BY lang HAVING sum(n_words) >= {rules.min_reference}),
doc_words AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(words) AS w FROM docs) GROUP BY doc_id, w),
top AS (
  SELECT lang, w, n FROM (
    SELECT lang, w, count(*) AS n FROM (SELECT lang, unnest(words) AS w FROM docs) GROUP BY lang, w) JOIN refs USING (lang)
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, w) <= {rules.common}),
bins AS (
  SELECT d.doc_id, r.lang, coalesce(x.n, 0) AS own, t.n AS ref FROM counted d, refs r, top t
  LEFT JOIN doc_words x ON x.doc_id = d.doc_id AND x.w = t.w WHERE t.lang = r.lang AND d.n_words >= 50),
all_bins AS (
  SELECT * FROM bins UNION ALL
  SELECT d.doc_id, b.lang, any_value(d.n_words) - sum(own), any_value(r.n_words) - sum(ref)
  FROM bins b JOIN counted d USING (doc_id) JOIN refs r ON r.lang = b.lang GROUP BY d.doc_id, b.lang),
by_word AS (
  SELECT doc_id, lang, sum({term("p", "q")}) AS s FROM (
    SELECT b.doc_id, b.lang, 1.0 * own / d.n_words AS p, 1.0 * ref / r.n_words AS q
    FROM all_bins b JOIN counted d USING (doc_id) JOIN refs r ON r.lang = b.lang) GROUP BY doc_id, lang),
near AS (
  SELECT DISTINCT d.doc_id FROM counted d JOIN by_word w USING (doc_id) JOIN refs r ON r.lang = w.lang
  WHERE (d.total_chars < {rules.min_chars}
         OR sqrt(greatest(({by_char}) / 2, 0)) <= {rules.max_chars} + {rules.noise} / sqrt(d.total_chars))
    AND (d.n_words < {rules.min_words} OR sqrt(greatest(s / 2, 0)) <= {rules.max_words} + {rules.noise} / sqrt(d.n_words))),
base AS (
  SELECT counted.doc_id, n_words::BIGINT AS n_words,
         length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
         (total_chars - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM counted LEFT JOIN covered ON covered.doc_id = counted.doc_id)
SELECT base.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND (near.doc_id IS NOT NULL OR NOT EXISTS (SELECT 1 FROM refs)) AS kept
FROM base LEFT JOIN near ON near.doc_id = base.doc_id
"""


ORACLE["op1_quality_rules"] = _quality_sql(Divergence())


def _license_sql(percent: int = 90) -> str:
    """Phrases at every word, and every block (a line and the words after it) against every template, without any filter.

    first_word and last_word can be null; as DOUBLE they reach pandas like Spark's nullable longs do.
    """
    phrases = ", ".join(f"(['{"', '".join(p.split())}'], '{label}')" for p, label in PHRASES.items())
    templates = [(n, label, token_set(text)) for n, (label, text) in enumerate(TEMPLATES)]
    rows = ", ".join(f"({n}, '{label}', {len(s)}, {-(-len(s) * percent // 100)}, '{t}')"
                     for n, label, s in templates for t in sorted(s))
    ahead = longest(TEMPLATES)
    return f"""
WITH docs AS (SELECT doc_id, lower(coalesce(text, '')) AS text FROM documents),
phrases(p, label) AS (VALUES {phrases}),
templates(n, label, size, need, token) AS (VALUES {rows}),
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(text, '{NO_WORD}'), lambda x: x <> '') AS w FROM docs),
places AS (
  SELECT doc_id, i - 1 AS place, label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words), phrases
  WHERE w[i:i + len(p) - 1] = p),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word FROM places GROUP BY doc_id),
line_words AS (
  SELECT doc_id, list_transform(string_split(text, chr(10)),
      lambda x: list_filter(regexp_split_to_array(x, '{NO_WORD}'), lambda y: y <> '')) AS lw FROM docs),
after_line AS (
  SELECT doc_id, i AS line_no, lw[i] AS own, lw[i + 1:i + {ahead}] AS nxt
  FROM (SELECT doc_id, lw, unnest(range(1, len(lw) + 1)) AS i FROM line_words)),
lines AS (
  SELECT doc_id, line_no, unnest(list_distinct(list_concat(own, flatten(
      nxt[1:coalesce(nullif(list_position(list_transform(nxt, lambda x: len(x) = 0), true), 0), len(nxt) + 1) - 1])[1:{ahead}]))) AS token
  FROM after_line),
matches AS (
  SELECT doc_id, label, count(*) / any_value(size) AS score FROM lines JOIN templates USING (token)
  GROUP BY doc_id, line_no, n, label HAVING count(*) >= any_value(need)),
labelled AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM places UNION ALL SELECT doc_id, label FROM matches) GROUP BY doc_id),
base_labelled AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY doc_id),
scored AS (SELECT doc_id, max(score) AS score FROM matches GROUP BY doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       first_word::DOUBLE AS first_word, last_word::DOUBLE AS last_word,
       coalesce(base_labelled.labels, '') AS base_labels, coalesce(labelled.labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN base_labelled USING (doc_id) LEFT JOIN labelled USING (doc_id)
     LEFT JOIN scored USING (doc_id)
"""


ORACLE["op7_license_scan"] = _license_sql()
