"""SQL for DuckDB of the manifest, its trees written out level by level, and of the licenses."""

from __future__ import annotations

from shelfcast.llm import licenses

# Levels written out: sources of up to 16 ** 6 documents, and up to 16 ** 3 sources.
SOURCE_LEVELS, TOP_LEVELS = 6, 3

_BIT = "CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384::BIGINT) ELSE r >> 1 END"


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text."""
    byte = (
        "list_reduce(list_concat([xor(c, b)], [i::BIGINT FOR i IN range(8)]), "
        f"lambda r, i: {_BIT})"
    )
    codes = f"[ord(x)::BIGINT FOR x IN string_split({text}, '')]"
    start = "[4294967295::BIGINT]"
    return (
        f"xor(list_reduce(list_concat({start}, {codes}), lambda c, b: {byte}), 4294967295::BIGINT)"
    )


def _field(value: str) -> str:
    shown = f"CAST({value} AS VARCHAR)"
    return f"COALESCE(CAST(strlen({shown}) AS VARCHAR) || ':' || {shown}, '-')"


def _leaf(text: str) -> str:
    fields = map(_field, ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({' || '.join(fields)})"


def _levels(name: str, levels: int) -> list[str]:
    """Tables of the levels above ``name0 (tree, pos, node, many)``, each node with its siblings."""
    out = []
    for level in range(levels):
        run = "PARTITION BY tree, pos // 16 ORDER BY pos ROWS BETWEEN"
        before = f"string_agg(node, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING)"
        behind = f"string_agg(node, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
        out.append(
            f"""{name}{level}_sided AS (
  SELECT *, COALESCE({before}, '') AS before, COALESCE({behind}, '') AS behind FROM {name}{level}),
{name}{level + 1} AS (
  SELECT tree, up AS pos, CASE WHEN many > 1 THEN sha256(joined) ELSE joined END AS node,
         (many + 15) // 16 AS many
  FROM (SELECT tree, pos // 16 AS up, many, string_agg(node, '' ORDER BY pos) AS joined
        FROM {name}{level} GROUP BY tree, pos // 16, many) g)"""
        )
    return out


def _fold(node: str, prefix: str, levels: int) -> list[tuple[str, str]]:
    """Columns that go up a path, each from the one before."""
    columns = []
    for level in range(levels):
        side = f"{prefix}{level}"
        above = f"CASE WHEN {side}.many > 1 THEN sha256({side}.before || {node} || {side}.behind) ELSE {node} END"
        columns.append((f"{prefix}{level}_node", above))
        node = f"{prefix}{level}_node"
    return columns


def manifest_sql() -> str:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``."""
    crc = crc32_sql("CAST(doc_id AS VARCHAR)")
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    joins, siblings = [], []
    for level in range(SOURCE_LEVELS):
        joins.append(
            f"JOIN s{level}_sided AS s{level} ON s{level}.tree = l.tree "
            f"AND s{level}.pos = l.pos // {16**level}"
        )
        siblings.append(f"s{level}.before || s{level}.behind")
    joins.append("JOIN t0 AS place ON place.name = l.tree")
    for level in range(TOP_LEVELS):
        joins.append(f"JOIN t{level}_sided AS t{level} ON t{level}.pos = place.pos // {16**level}")
        siblings.append(f"t{level}.before || t{level}.behind")
    folds = _fold("l.changed", "s", SOURCE_LEVELS)
    folds += _fold(folds[-1][0], "t", TOP_LEVELS)
    columns = ",\n         ".join(f"{expression} AS {name}" for name, expression in folds)
    return f"""
WITH leaves AS (
  SELECT COALESCE('=' || source, '') AS tree, doc_id, {_leaf("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {_leaf(lowered)}
              ELSE {_leaf("text")} END AS changed
  FROM documents),
l AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaves),
s0 AS (SELECT tree, pos, leaf AS node, COUNT(*) OVER (PARTITION BY tree) AS many FROM l),
{", ".join(_levels("s", SOURCE_LEVELS))},
t0 AS (
  SELECT '' AS tree, tree AS name, ROW_NUMBER() OVER (ORDER BY tree) - 1 AS pos, node,
         COUNT(*) OVER () AS many
  FROM s{SOURCE_LEVELS}),
{", ".join(_levels("t", TOP_LEVELS))},
climbed AS (
  SELECT l.doc_id, l.leaf, place.node AS subroot, sha256({" || ".join(siblings)}) AS proof_sha256,
         {columns}
  FROM l {" ".join(joins)})
SELECT doc_id, leaf, subroot, top.node AS root, proof_sha256,
       {folds[-1][0]} AS folded_root, {folds[-1][0]} = top.node AS verified
FROM climbed, t{TOP_LEVELS} AS top"""


def _text_sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def licenses_sql(templates=None) -> str:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    All templates of the query stand in it: notices, names and passages.
    """
    templates = licenses.all_templates() if templates is None else templates
    rows = ", ".join(
        f"({number}, '{label}', {_text_sql(text)}, {_text_sql(codes)}, {least}, {start}, {grams})"
        for (label, text), (number, _, codes, least, start, grams) in zip(
            templates, licenses.template_rules(templates)
        )
    )
    return f"""
WITH templates AS (
  SELECT template, label, string_split(x, ' ') AS words, coded, least, named_from, named_grams
  FROM (VALUES {rows}) v(template, label, x, coded, least, named_from, named_grams)),
template_grams AS (
  SELECT template, i - 1 AS t, len(words) < {licenses.SHORT} AS short,
         words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT *, unnest(range(1, len(words) - 1)) AS i FROM templates) u),
worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
placed AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
base AS (
  SELECT doc_id, i - 1 AS place, unnest([x FOR x IN [
           CASE WHEN w[i] = 'mit' AND w[i + 1] = 'license' THEN 'mit' END,
           CASE WHEN w[i] = 'apache' AND w[i + 1] = 'license' THEN 'apache' END,
           CASE WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl' END]
         IF x IS NOT NULL]) AS label
  FROM placed),
based AS (
  SELECT doc_id, COUNT(*) AS n_base, MIN(place) AS first_word, MAX(place) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM base GROUP BY doc_id),
matches AS (
  SELECT p.doc_id, g.template, g.short, i - 1 AS d, t
  FROM placed p JOIN template_grams g
    ON w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] = g.gram),
apart AS (
  SELECT *, d - t - LAG(d - t) OVER (PARTITION BY doc_id, template ORDER BY d - t)
              > CASE WHEN short THEN 0 ELSE {licenses.MERGE} END AS far
  FROM matches),
copies AS (
  SELECT *, SUM(CASE WHEN far THEN 1 ELSE 0 END)
              OVER (PARTITION BY doc_id, template ORDER BY d - t) AS copy
  FROM apart),
ends AS (
  SELECT doc_id, template, copy, MIN(d) AS first_place, MAX(d) + 3 AS end_place
  FROM copies GROUP BY doc_id, template, copy),
named AS (
  SELECT doc_id, template, copy, MAX(grams) AS grams FROM (
    SELECT doc_id, template, copy, d - t AS diagonal, COUNT(DISTINCT t) AS grams
    FROM copies JOIN templates USING (template)
    WHERE t >= named_from AND t < named_from + named_grams
    GROUP BY doc_id, template, copy, d - t) n
  GROUP BY doc_id, template, copy),
codes AS (
  SELECT DISTINCT doc_id, template, copy, d + step AS word, substr(coded, t + step + 1, 1) AS code
  FROM copies JOIN templates USING (template), range(0, 3) s(step)),
shown AS (
  SELECT doc_id, template, copy, first_place, end_place,
         string_agg(COALESCE(code, '{licenses.OTHER}'), '' ORDER BY word) AS shown
  FROM (SELECT *, unnest(range(first_place, end_place)) AS word FROM ends) e
  LEFT JOIN codes USING (doc_id, template, copy, word)
  GROUP BY doc_id, template, copy, first_place, end_place),
aligned AS (
  SELECT s.*, label, 1 - levenshtein(shown, coded) / CAST(length(coded) AS DOUBLE) AS cover
  FROM shown s JOIN templates USING (template) LEFT JOIN named USING (doc_id, template, copy)
  WHERE 1 - levenshtein(shown, coded) / CAST(length(coded) AS DOUBLE) >= least
    AND (named_grams = 0 OR grams = named_grams)),
won AS (
  SELECT *, cover = MAX(cover) OVER (PARTITION BY doc_id, word) AS best
  FROM (SELECT *, unnest(range(first_place, end_place)) AS word FROM aligned) a),
seen AS (
  SELECT doc_id, label, cover FROM won
  GROUP BY doc_id, template, copy, label, cover, first_place, end_place
  HAVING 2 * COUNT(CASE WHEN best THEN 1 END) >= end_place - first_place),
both_labels AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (
    SELECT doc_id, label FROM seen UNION ALL SELECT doc_id, label FROM base) b GROUP BY doc_id),
best AS (SELECT doc_id, MAX(cover) AS cover FROM seen GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_base, 0) AS n_base, first_word,
       last_word, COALESCE(base_labels, '') AS base_labels, COALESCE(labels, '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE COALESCE(cover, 0.0::DOUBLE) END AS score
FROM worded LEFT JOIN based USING (doc_id) LEFT JOIN both_labels USING (doc_id)
  LEFT JOIN best USING (doc_id)"""
