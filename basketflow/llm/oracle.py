"""SQL that the training-data queries must match, where SQL can express them.

The other operators rest on learned models, sketches, components or merges, and are held against
brute-force versions in ``tests/llm`` instead.
"""

from __future__ import annotations

from .licenses import TEMPLATES, THRESHOLD


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _bigrams(words: str) -> str:
    return f"list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1])"


def _words(text: str) -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"regexp_extract_all(translate({text}, '{upper}', '{lower}'), '[0-9a-z]+')"


def license_scan() -> str:
    """Every line against every template, without pruning."""
    values = ", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in sorted(TEMPLATES.items()))
    return f"""WITH named(template, body) AS (VALUES {values}),
        templates AS (SELECT template, {_bigrams('w')} AS own
          FROM (SELECT template, {_words('body')} AS w FROM named)),
        lines AS (SELECT doc_id, line_no, {_bigrams('w')} AS grams
          FROM (SELECT doc_id, line_no, {_words('line')} AS w
                FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
                        generate_subscripts(string_split(text, chr(10)), 1) AS line_no
                      FROM documents)) WHERE len(w) > 1),
        scored AS (SELECT doc_id, line_no, template,
            2.0::DOUBLE * len(list_intersect(grams, own)) / (len(grams) + len(own)) AS dice
          FROM lines, templates
          WHERE len(grams) BETWEEN len(own) / 2 AND len(own) * 2),
        best AS (SELECT doc_id, max(dice) AS dice, max_by(template, (dice, template)) AS template
          FROM scored WHERE dice >= {THRESHOLD} GROUP BY doc_id, line_no)
      SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_notices,
        coalesce(names, '') AS templates, coalesce(top, 0.0::DOUBLE) AS best_dice
      FROM documents d LEFT JOIN (
        SELECT doc_id, count(*) AS n, max(dice) AS top,
          array_to_string(list_sort(list(DISTINCT template)), ',') AS names
        FROM best GROUP BY doc_id) b ON d.doc_id = b.doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op9_license_scan": license_scan()}
