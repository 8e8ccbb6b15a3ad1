"""SQL of corpus queries, for DuckDB."""

from __future__ import annotations

from seriesmill.llm import licenses


def crc32(value: str) -> str:
    """Unsigned crc32 of an integer's decimal digits, bit by bit (0xEDB88320 is the polynomial of the checksum)."""
    byte = "list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda k: 0::BIGINT)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    digits = f"list_transform(string_split({value}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    done = f"list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: xor(c >> 8, {byte.replace('xor(c, b)', 'xor(c, b) & 255')}))"
    return f"xor({done}, 4294967295)"


def _levels(name: str, leaves: str, most: int) -> str:
    """``name0`` .. of (tree, spot, digest, n, nodes of its run): n nodes of a tree, 16 of them a node above, until one is left."""
    out = []
    for k in range(most):
        if not k:
            source = leaves
        else:
            below = f"{name}{k - 1}"
            source = (
                f"SELECT tree, spot // 16 AS spot, sha256(string_agg(digest, '' ORDER BY spot)) AS digest FROM {below} WHERE n > 1 GROUP BY tree, spot // 16"
                f" UNION ALL SELECT tree, spot, digest FROM {below} WHERE n = 1"
            )
        out.append(
            f"{name}{k} AS MATERIALIZED (SELECT *, list(digest) OVER (PARTITION BY tree, spot // 16 ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS run"
            f" FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM ({source})))"
        )
    return ",\n".join(out)


def _path(name: str, tree: str, at: str, most: int) -> tuple[str, list[str], list[str]]:
    """Joins that find the run of a leaf on each level, and the digests left and right of its path."""
    joins, left, right = [], [], []
    for k in range(most):
        place = f"({at} // {16**k})"
        joins.append(f"LEFT JOIN {name}{k} AS j{name}{k} ON j{name}{k}.n > 1 AND j{name}{k}.tree = {tree} AND j{name}{k}.spot = {place}")
        run = f"j{name}{k}.run"
        left.append(f"coalesce(list_aggregate({run}[1:({place} % 16)], 'string_agg', ''), '')")
        right.append(f"coalesce(list_aggregate({run}[({place} % 16) + 2:], 'string_agg', ''), '')")
    return "\n".join(joins), left, right


def _manifest(most: int = 6, most_sources: int = 4) -> str:
    def hashed(text: str) -> str:
        parts = [f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    joins, left, right = _path("s", "l.tree", "l.spot", most)
    more, left2, right2 = _path("t", "1", "r.spot", most_sources)
    steps, folded = ["f0 AS (SELECT *, CASE WHEN forged THEN seen ELSE leaf END AS x FROM paths)"], 0
    lefts, rights = left + left2, right + right2
    on = [f"js{k}.n" for k in range(most)] + [f"jt{k}.n" for k in range(most_sources)]
    for k in range(len(lefts)):
        folded = k + 1
        steps.append(f"f{folded} AS (SELECT * REPLACE (CASE WHEN on{k} IS NULL THEN x ELSE sha256(l{k} || x || r{k}) END AS x) FROM f{k})")
    columns = ", ".join(f"{a} AS l{k}, {b} AS r{k}, {c} AS on{k}" for k, (a, b, c) in enumerate(zip(lefts, rights, on, strict=True)))
    proof = " || ".join(f"l{k} || r{k}" for k in range(len(lefts)))
    chain = ",\n".join(steps)
    return f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, {hashed('text')} AS leaf, {hashed(low)} AS seen, {crc32('doc_id')} % 5 = 0 AS forged FROM documents
), placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot FROM leaves),
{_levels('s', 'SELECT tree, spot, leaf AS digest FROM placed', most)},
roots AS MATERIALIZED (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS spot FROM s{most - 1}),
{_levels('t', 'SELECT 1 AS tree, spot, subroot AS digest FROM roots', most_sources)},
paths AS MATERIALIZED (
  SELECT l.doc_id, l.leaf, l.seen, l.forged, r.subroot, top.digest AS root, {columns}
  FROM placed AS l JOIN roots AS r ON r.tree = l.tree CROSS JOIN t{most_sources - 1} AS top
{joins}
{more}
), {chain}
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, x AS folded_root, x = root AS verified FROM f{folded}
"""


#: Up to 16 ** 5 rows of a source and 16 ** 3 sources.
MANIFEST_SQL = _manifest()


def _pattern(items: list) -> str:
    """A template's items over words that are each followed by a space."""
    out = ""
    for item in items:
        if isinstance(item, str):
            out += f"{item} "
        elif isinstance(item, list):
            out += f"(?:{_pattern(item)})?"
        else:
            out += f"(?:[^ ]+ ){{{item[0]},{item[1]}}}"
    return out


def _licenses() -> str:
    def with_label(kept: list[licenses.Template]) -> str:
        each = [f"CASE WHEN found[{licenses_in.index(t) + 1}] THEN '{t.label}' END" for t in kept]
        return f"coalesce(list_aggregate(list_sort(list_distinct(list_filter([{', '.join(each)}], lambda x: x IS NOT NULL))), 'string_agg', ','), '')"

    licenses_in = list(licenses.PHRASES + licenses.TEMPLATES)
    found = ", ".join(f"regexp_matches(flat, ' {_pattern(licenses.parsed(t.wording))}')" for t in licenses_in)
    weights = ", ".join(f"CASE WHEN found[{k + 1}] THEN {licenses.mandatory(licenses.parsed(t.wording))} ELSE 0 END" for k, t in enumerate(licenses_in))
    places = []
    for t in licenses.PHRASES:
        words = t.wording.split()
        places.append("(" + " AND ".join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(words)) + ")")
    return rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), flat AS (SELECT doc_id, w, ' ' || coalesce(list_aggregate(w, 'string_agg', ' '), '') || ' ' AS flat FROM words),
found AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, list_filter(range(len(w)), lambda i: {' OR '.join(places)}) AS places, [{found}] AS found FROM flat
)
SELECT doc_id, n_words, len(places)::BIGINT AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  {with_label(list(licenses.PHRASES))} AS base_labels, {with_label(licenses_in)} AS labels,
  list_max([{weights}]) / (list_max([{weights}]) + 1.0)::DOUBLE AS score
FROM found
"""


LICENSE_SQL = _licenses()


TRIE_SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || ':' || coalesce(text, '')) AS id,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(id ORDER BY turn NULLS FIRST, id) AS ids, list(words ORDER BY turn NULLS FIRST, id) AS words, {crc32('conv_id')} % 4 AS h FROM turns GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.ids[1:c.h], []), c.ids[c.h + 1:]) AS ids, list_concat(coalesce(b.words[1:c.h], []), c.words[c.h + 1:]) AS words
  FROM own AS c LEFT JOIN own AS b ON b.conv_id = c.conv_id - c.conv_id % 20
), members AS (
  SELECT conv_id, d, ids[1:d] AS key, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(ids) AS ends FROM rebuilt, unnest(range(len(ids) + 1)) AS u(d)
), nodes AS MATERIALIZED (
  SELECT key, d, min(conv_id) AS conv_id, count(*) AS n, max(words) AS words, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY key, d
), children AS MATERIALIZED (SELECT key[1:d - 1] AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT x.key[1:a] AS key, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((x.n - 1) * x.words) AS saved
  FROM nodes AS x LEFT JOIN children AS c ON c.key = x.key, unnest(range(x.d + 1)) AS u(a) GROUP BY 1
)
SELECT x.conv_id, x.d AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(c.n, 0)::BIGINT AS n_children, b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, x.ends_sha256
FROM nodes AS x JOIN below AS b ON b.key = x.key LEFT JOIN children AS c ON c.key = x.key LEFT JOIN nodes AS p ON x.d > 0 AND p.key = x.key[1:x.d - 1]
"""
