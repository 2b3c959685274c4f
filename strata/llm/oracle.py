"""DuckDB statements of the corpus queries that SQL can express."""

from __future__ import annotations

from strata.llm import licenses

OP1 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS least FROM pages
), r AS (
  SELECT *, CASE WHEN strlen(payload) >= 100 AND page_id IS DISTINCT FROM least THEN least END AS refers_to FROM p
)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM r"""


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op3() -> str:
    """Sentence look-up and rule chain of the licence scan, one CTE a rule."""
    known = ", ".join(f"{_quote(s)}: {_quote(i)}" for s, i in licenses.known_sentences().items())
    ends = r"[.!?;:]+[ \t\r\n]+|[.!?;:]+$"
    plain = f"trim(regexp_replace(translate(s, '{licenses.UPPER}', '{licenses.LOWER}'), '[^a-z0-9]+', ' ', 'g'), ' ')"
    normal = f"regexp_replace({plain}, '{licenses.HOLDER}', '{licenses.HELD}')"

    def ids(sentences: str) -> str:
        return f"list_filter(list_transform({sentences}, lambda s: MAP {{{known}}}[{normal}]), lambda i: i IS NOT NULL)"

    by_line = f"flatten(list_transform(string_split(text, chr(10)), lambda l: string_split_regex(l, '{ends}')))"
    joined = f"string_split_regex(replace(text, chr(10), ' '), '{ends}')"
    sequence = "array_to_string(list_transform({}, lambda i: ',' || i || ','), '')"
    steps = [f"""d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
i AS (SELECT doc_id, {ids(by_line)} AS a, {ids(joined)} AS b FROM d),
s0 AS (SELECT *, {sequence.format('a')} AS a0, {sequence.format('b')} AS b0 FROM i)"""]
    hits = []
    for k, (name, rule) in enumerate(licenses.RULES):
        pattern = _quote("".join(f",{i}," for i in rule))
        steps.append(f"s{k + 1} AS (SELECT *, replace(a{k}, {pattern}, '|') AS a{k + 1}, "
                     f"replace(b{k}, {pattern}, '|') AS b{k + 1} FROM s{k})")
        hits.append((k, name, pattern))
    found = ", ".join(f"CASE WHEN contains({x}{k}, {p}) THEN {_quote(n)} END" for x in "ab" for k, n, p in hits)
    first = "list_filter({0}, lambda x, i: list_position({0}, x) = i)"
    return f"""WITH {", ".join(steps)},
f AS (SELECT doc_id, a, list_filter([{found}], lambda x: x IS NOT NULL) AS f,
  list_filter(b, lambda x: NOT list_contains(a, x)) AS more FROM s{len(licenses.RULES)})
SELECT doc_id, coalesce(array_to_string({first.format('f')}, ','), '') AS licenses,
  coalesce(array_to_string(list_concat(a, {first.format('more')}), ','), '') AS sentence_ids FROM f"""


ORACLE: dict[str, str] = {"op1_warc": OP1, "op3_license_scan": op3()}
