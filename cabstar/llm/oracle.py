"""DuckDB SQL of the registered queries that SQL can express on whole tables.

The others search approximately, fit a model, link by transitive similarity or follow a
tokenizer's merges; tests hold them against brute force, the library or held-out labels.
"""

from __future__ import annotations

import re

# Fixed values, written out here again so that a wrong rule or label in the code under test
# shows up as a difference: patterns that are blocked, and licence texts with the phrases
# that must stand in a file (label, whether of the contract, text, phrases).
BLOCKED_PATTERNS = [
    "/login^", "/signin^", "/wp-login.php", "/wp-admin/", "/cgi-bin/", "/checkout^", "/cart^", "^phpsessid=",
    "^sessionid=", "^add-to-cart=", "/ads/*", "/casino^", "/xxx/", "/torrent^", ".exe|", ".zip|", ".jpg|",
]
LICENCE_TEXTS = [
    ("cc-by", True, "cc by", ["cc by"]),
    ("gpl", True, "general public license", ["general public license"]),
    ("reserved", True, "all rights reserved", ["all rights reserved"]),
    ("apache-2.0", False, "licensed under the apache license version 2 0", ["apache license version 2"]),
    (
        "mit",
        False,
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
        " documentation files",
        ["granted free of charge", "this software and associated documentation files"],
    ),
    (
        "bsd",
        False,
        "redistribution and use in source and binary forms with or without modification are permitted provided that"
        " the following conditions are met",
        ["source and binary forms"],
    ),
    (
        "isc",
        False,
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
        " granted",
        ["for any purpose with or without fee"],
    ),
    ("mpl-2.0", False, "subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("lgpl", False, "gnu lesser general public license", ["lesser general public license"]),
    ("agpl", False, "gnu affero general public license", ["affero general public license"]),
    ("cc-by-sa", False, "creative commons attribution sharealike", ["attribution sharealike"]),
    ("cc-by", False, "creative commons attribution", ["creative commons attribution"]),
    ("cc0", False, "cc0 1 0 universal", ["cc0 1 0"]),
    ("unlicense", False, "free and unencumbered software released into the public domain", ["the public domain"]),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _lower(column: str) -> str:
    return f"translate({column}, '{_UPPER}', '{_LOWER}')"


def _words(column: str) -> str:
    return rf"regexp_extract_all({_lower(f'COALESCE({column}, {_text('')})')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _pattern_regex(pattern: str) -> str:
    """A substring pattern as an RE2 expression."""
    body = pattern.removesuffix("|")
    signs = {"*": "(?s:.*)", "^": r"(?:[^0-9A-Za-z_.%-]|\z)", ".": r"\.", "?": r"\?", "+": r"\+"}
    return "".join(signs.get(c, c) for c in body) + (r"\z" if pattern.endswith("|") else "")


_PATTERNS = ", ".join(f"({_text(p)}, {_text(_pattern_regex(p))})" for p in BLOCKED_PATTERNS)

URLS = rf"""WITH parts AS (
  SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
  FROM pages
), hosts AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM parts
), split AS (
  SELECT page_id, {_lower('raw')} AS host, substr(rest, length(raw) + 1) AS tail FROM hosts
), subjects AS (
  SELECT page_id, host, regexp_extract(tail, '^[^?#]*') AS path, host || tail AS subject FROM split
), rules(rule, rule_host, rule_path, verdict) AS (
  VALUES ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
         ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'),
         ('net/fr/', 'net', '/fr/', 'block')
), patterns(pattern, rx) AS (VALUES {_PATTERNS}),
named AS (
  SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS verdict
  FROM subjects JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id
), plain AS (
  SELECT page_id, min(pattern) AS pattern FROM subjects JOIN patterns ON regexp_matches(subject, rx) GROUP BY page_id
)
SELECT s.page_id, s.host, s.path, n.rule, COALESCE(n.verdict, CASE WHEN p.pattern IS NULL THEN 'allow' ELSE 'block' END)
    AS verdict, CASE WHEN n.rule IS NULL THEN p.pattern ELSE '||' || n.rule END AS pattern
FROM subjects s LEFT JOIN named n ON s.page_id = n.page_id LEFT JOIN plain p ON s.page_id = p.page_id"""


def _template_rows() -> str:
    rows = []
    for i, (label, base, text, phrases) in enumerate(LICENCE_TEXTS):
        size, places = len(text.split()), set()
        for phrase in phrases:
            first = text[: re.search(rf"\b{phrase}\b", text).start()].count(" ")
            places |= set(enumerate(phrase.split(), first))
        for place, word in sorted(places):
            rows.append(f"({i}, {_text(label)}, {str(base).upper()}, {size}, {place}, {_text(word)})")
    return ", ".join(rows)


def _template_words() -> str:
    return ", ".join(
        f"({i}, {place}, {_text(word)})"
        for i, (_, _, text, _) in enumerate(LICENCE_TEXTS)
        for place, word in enumerate(text.split())
    )


LICENCES = rf"""WITH docs AS (SELECT doc_id, {_words('text')} AS words FROM documents),
mandatory(t, label, base, n, place, word) AS (VALUES {_template_rows()}),
template(t, place, word) AS (VALUES {_template_words()}),
places AS (
  SELECT doc_id, word, pos - 1 AS pos
  FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM docs)
  WHERE word IN (SELECT word FROM template)
), starts AS (
  SELECT doc_id, t, label, base, n, pos - place AS start
  FROM places JOIN mandatory USING (word)
  GROUP BY ALL HAVING COUNT(*) = (SELECT COUNT(*) FROM mandatory m WHERE m.t = any_value(mandatory.t))
), shares AS (
  SELECT s.doc_id, s.t, COUNT(DISTINCT p.pos) / (COUNT(DISTINCT s.start) * any_value(s.n)) AS share
  FROM starts s JOIN template w ON s.t = w.t
  LEFT JOIN places p ON p.doc_id = s.doc_id AND p.word = w.word AND p.pos = s.start + w.place
  GROUP BY s.doc_id, s.t
), found AS (
  SELECT doc_id, COUNT(*) FILTER (base) AS n_base, MIN(start) FILTER (base) AS first_word,
    MAX(start) FILTER (base) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label))), ',') AS labels
  FROM starts GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, COALESCE(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
  CAST(last_word AS BIGINT) AS last_word, COALESCE(base_labels, '') AS base_labels, COALESCE(labels, '') AS labels,
  CAST(COALESCE((SELECT MAX(share) FROM shares s WHERE s.doc_id = d.doc_id), 0.0) AS DOUBLE) AS score
FROM docs d LEFT JOIN found f ON d.doc_id = f.doc_id"""

DECONTAMINATION = rf"""WITH docs AS (SELECT doc_id, {_words('text')} AS words FROM documents),
items AS (SELECT item_id, {_words('text')} AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS size, array_to_string(words[i + 1 : i + least(13, len(words))], ' ') AS w
  FROM (SELECT *, unnest(range(greatest(1, len(words) - 12))) AS i FROM items WHERE len(words) > 0)
), sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT doc_id, size, i, array_to_string(words[i + 1 : i + size], ' ') AS w
  FROM (SELECT doc_id, words, size, unnest(range(len(words) - size + 1)) AS i FROM docs JOIN sizes ON len(words) >= size)
), hits AS (SELECT doc_id, item_id, i, g.size AS size FROM grams g JOIN windows USING (size, w)),
covered AS (SELECT doc_id, COUNT(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
named AS (
  SELECT doc_id, COUNT(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS ids
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(COALESCE(c.n, 0) AS BIGINT) AS n_hit,
  CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256,
  COALESCE(c.n, 0) > 0 AND 20 * COALESCE(c.n, 0) >= len(words) AS contaminated
FROM docs d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN named m ON d.doc_id = m.doc_id"""

RANKED = rf"""WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, {_words('text')} AS words FROM documents
), texts AS (SELECT d, doc_id, len(words) AS n, words FROM docs WHERE len(words) > 0),
total AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS length FROM texts),
items AS (
  SELECT item, item_id, unnest(list_distinct({_words('text')})) AS term
  FROM (SELECT row_number() OVER () AS item, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark))
), held AS (
  SELECT d, doc_id, n, term, COUNT(*) AS tf
  FROM (SELECT d, doc_id, n, unnest(words) AS term FROM texts) WHERE term IN (SELECT term FROM items)
  GROUP BY d, doc_id, n, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
  FROM held, total GROUP BY term
), scores AS (
  SELECT item, item_id, doc_id, d,
    CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
  FROM held JOIN items USING (term) JOIN weights USING (term), total GROUP BY item, item_id, doc_id, d
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50"""

ORACLE: dict[str, str] = {
    "op3_url_filter": URLS,
    "op5_licences": LICENCES,
    "op9_decontaminate": DECONTAMINATION,
    "op13_lexical": RANKED,
}
