"""The string similarities and pair features in SQL, to check them by: subsequences by bit masks, up to 125 characters."""

from __future__ import annotations


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: a's places as bits of one number, which each character of b updates."""
    one = "1::HUGEINT"
    masks = f"list_transform(range(1, length({b}) + 1), lambda j: list_sum(list_transform(range(0, length({a})), lambda i: CASE WHEN substr({a}, i::BIGINT + 1, 1) = substr({b}, j, 1) THEN {one} << i::INT ELSE 0::HUGEINT END))::HUGEINT)"
    full = f"(({one} << length({a})::INT) - 1)"
    step = f"list_reduce(list_prepend({full}, {masks}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})"
    return f"CASE WHEN length({a}) = 0 OR length({b}) = 0 THEN 0 ELSE length({a}) - bit_count({step}) END"


RATIO = "CASE WHEN length({x}) + length({y}) = 0 THEN 100 ELSE 200::DOUBLE * {l} / (length({x}) + length({y})) END"


def words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '\\s+'), lambda t: t <> '')"


def sorted_words(c: str) -> str:
    return f"array_to_string(list_sort({c}), ' ')"


def similarities(texts: str) -> str:
    """Named queries, the last of which, sims, has x, y and each similarity of them, for the rows x, y of the query texts."""
    pick = lambda a, b: f"CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END"
    other = lambda a, b: f"CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END"
    look = lambda name, a, b: f"LEFT JOIN lcss {name} ON {name}.a = {pick(a, b)} AND {name}.b = {other(a, b)}"
    part = lambda name, a, b: f"LEFT JOIN pieced {name} ON {name}.a = {pick(a, b)} AND {name}.b = {other(a, b)}"
    return f"""texts AS ({texts}),
tok AS (SELECT x, y, {words("x")} AS tx, {words("y")} AS ty FROM (SELECT DISTINCT x, y FROM texts)),
forms AS (SELECT x, y, tx, ty, {sorted_words("tx")} AS sx, {sorted_words("ty")} AS sy, {sorted_words("list_distinct(tx)")} AS ux, {sorted_words("list_distinct(ty)")} AS uy,
  {sorted_words("list_distinct(list_filter(tx, lambda t: NOT list_contains(ty, t)))")} AS dx, {sorted_words("list_distinct(list_filter(ty, lambda t: NOT list_contains(tx, t)))")} AS dy,
  {sorted_words("list_distinct(list_filter(tx, lambda t: list_contains(ty, t)))")} AS common FROM tok),
wholes AS (SELECT DISTINCT {pick("x", "y")} AS a, {other("x", "y")} AS b FROM (SELECT x, y FROM forms UNION SELECT sx, sy FROM forms UNION SELECT ux, uy FROM forms)),
cuts AS (SELECT a, b, a AS p, substr(b, greatest(i, 0) + 1, least(i + length(a), length(b)) - greatest(i, 0)) AS q FROM (SELECT a, b, unnest(range(1 - length(a), length(b))) AS i FROM wholes WHERE a <> '')
  UNION SELECT a, b, b, substr(a, greatest(i, 0) + 1, least(i + length(b), length(a)) - greatest(i, 0)) FROM (SELECT a, b, unnest(range(1 - length(b), length(a))) AS i FROM wholes WHERE a <> '' AND length(a) = length(b))),
lcss AS (SELECT a, b, {lcs("a", "b")} AS l FROM (SELECT DISTINCT {pick("p", "q")} AS a, {other("p", "q")} AS b FROM (SELECT a AS p, b AS q FROM wholes UNION SELECT p, q FROM cuts UNION SELECT dx, dy FROM forms))),
pieced AS (SELECT c.a, c.b, max({RATIO.format(x="p", y="q", l="k.l")}) AS best FROM cuts c {look("k", "p", "q")} GROUP BY c.a, c.b
  UNION ALL SELECT a, b, CASE WHEN b = '' THEN 100 ELSE 0 END FROM wholes WHERE a = ''),
parts AS (SELECT f.*, {RATIO.format(x="x", y="y", l="k1.l")} AS ratio, {RATIO.format(x="sx", y="sy", l="k2.l")} AS token_sort_ratio, p1.best AS partial_ratio,
  CASE WHEN common <> '' THEN 100 WHEN len(list_distinct(tx)) < len(tx) OR len(list_distinct(ty)) < len(ty) THEN greatest(p2.best, p3.best) ELSE p2.best END AS partial_token_ratio,
  CASE WHEN len(tx) = 0 OR len(ty) = 0 THEN 0 WHEN common <> '' AND (dx = '' OR dy = '') THEN 100 WHEN common = '' THEN 100 * (1 - (length(dx) + length(dy) - 2 * k3.l)::DOUBLE / (length(dx) + length(dy)))
    ELSE greatest(100 * (1 - (length(dx) + length(dy) - 2 * k3.l)::DOUBLE / (2 * length(common) + 2 + length(dx) + length(dy))), 200::DOUBLE * length(common) / (2 * length(common) + 1 + length(dx)),
      200::DOUBLE * length(common) / (2 * length(common) + 1 + length(dy))) END AS token_set_ratio
  FROM forms f {look("k1", "x", "y")} {look("k2", "sx", "sy")} {look("k3", "dx", "dy")} {part("p1", "x", "y")} {part("p2", "sx", "sy")} {part("p3", "ux", "uy")}),
sims AS (SELECT x, y, ratio, token_sort_ratio, token_set_ratio, partial_ratio, jaro_winkler_similarity(x, y) AS jaro_winkler,
  CASE WHEN x = '' OR y = '' THEN 0 WHEN greatest(length(x), length(y))::DOUBLE / least(length(x), length(y)) < 1.5 THEN greatest(ratio, 0.95::DOUBLE * greatest(token_sort_ratio, token_set_ratio))
    WHEN greatest(length(x), length(y))::DOUBLE / least(length(x), length(y)) <= 8 THEN greatest(ratio, 0.9::DOUBLE * partial_ratio, 0.95::DOUBLE * 0.9::DOUBLE * partial_token_ratio)
    ELSE greatest(ratio, 0.6::DOUBLE * partial_ratio, 0.95::DOUBLE * 0.6::DOUBLE * partial_token_ratio) END AS wratio FROM parts)"""


def columns(values: dict[str, str]) -> str:
    return ", ".join(f"round(({v})::DOUBLE, 6) AS {k}" for k, v in values.items())


def jaccard(a: str, b: str, none: str) -> str:
    union, shared = f"len(list_distinct(list_concat({a}, {b})))", f"len(list_intersect(list_distinct({a}), list_distinct({b})))"
    return f"CASE WHEN {union} = 0 THEN {none} ELSE {shared} / {union} END"


def digits(c: str) -> str:
    return f"regexp_extract_all({c}, '[0-9]+')"


VETO = "CASE WHEN len(d1) > 0 AND len(d2) > 0 AND NOT list_has_any(d1, d2) THEN 1 ELSE 0 END"
HOUSE = "CASE WHEN len(d1) > 0 AND len(d2) > 0 AND d1[1] <> d2[1] AND NOT list_contains(d2, d1[1]) AND NOT list_contains(d1, d2[1]) THEN 1 ELSE 0 END"


def relative_difference(a: str, b: str) -> str:
    return f"abs(length({a}) - length({b})) / greatest(length({a}), length({b}), 1)"


def _features(pairs: str, clean_name: str, clean_address: str, names: dict[str, str], of_digits: tuple[str, str], full: bool = False) -> str:
    """pairs: named queries up to pairs, with n1, a1, n2, a2; clean_*: SQL with {}, for a column."""
    texts = "SELECT n1 AS x, n2 AS y FROM base UNION SELECT a1, a2 FROM base" + (" UNION SELECT n1 || ' ' || a1, n2 || ' ' || a2 FROM base" if full else "")
    cleaned = ", ".join(f"{clean_name.format(c)} AS {c}" for c in ("n1", "n2")) + ", " + ", ".join(f"{clean_address.format(c)} AS {c}" for c in ("a1", "a2"))
    joins = "JOIN sims n ON n.x = n1 AND n.y = n2 JOIN sims a ON a.x = a1 AND a.y = a2" + (" JOIN sims f ON f.x = n1 || ' ' || a1 AND f.y = n2 || ' ' || a2" if full else "")
    return f"""{pairs}, base AS (SELECT source1_entity_id, candidate_entity_id, blocking_rank, score, {cleaned} FROM pairs), {similarities(texts)}
SELECT source1_entity_id, candidate_entity_id, score{'' if 'blocking_rank' in names else ', blocking_rank'}, {columns(names)} FROM (SELECT *, {digits(of_digits[0])} AS d1, {digits(of_digits[1])} AS d2 FROM base) {joins}"""


def mode_a(pairs: str) -> str:
    return _features(pairs, "regexp_replace(lower({}), '^\\s+|\\s+$', '', 'g')", "regexp_replace(lower({}), '^\\s+|\\s+$', '', 'g')", {
        "name_token_sort_ratio": "n.token_sort_ratio", "name_wratio": "n.wratio", "name_partial_ratio": "n.partial_ratio", "address_token_set_ratio": "a.token_set_ratio", "address_token_sort_ratio": "a.token_sort_ratio",
        "address_levenshtein": "CASE WHEN greatest(length(a1), length(a2)) = 0 THEN 100 ELSE 100 * (1 - levenshtein(a1, a2) / greatest(length(a1), length(a2))) END",
        "number_overlap": jaccard("d1", "d2", "-1"), "len_diff_name": relative_difference("n1", "n2"), "len_diff_addr": relative_difference("a1", "a2"), "blocking_rank": "blocking_rank",
        "name_token_overlap": jaccard(words("n1"), words("n2"), "1"), "addr_token_overlap": jaccard(words("a1"), words("a2"), "1"), "veto_flag": VETO,
    }, ("n1 || ' ' || a1", "n2 || ' ' || a2"))


def mode_b(pairs: str, clean_name: str, clean_address: str) -> str:
    there = lambda c: f"CASE WHEN a1 <> '' AND a2 <> '' THEN a.{c} / 100 ELSE 0 END"
    return _features(pairs, clean_name, clean_address, {
        "name_ratio": "n.ratio / 100", "name_partial_ratio": "n.partial_ratio / 100", "name_token_sort_ratio": "n.token_sort_ratio / 100", "name_token_set_ratio": "n.token_set_ratio / 100", "name_jaro_winkler": "n.jaro_winkler",
        "addr_ratio": there("ratio"), "addr_token_set_ratio": there("token_set_ratio"), "addr_partial_ratio": there("partial_ratio"), "addr_is_null_s1": "CASE WHEN a1 = '' THEN 1 ELSE 0 END", "addr_is_null_cand": "CASE WHEN a2 = '' THEN 1 ELSE 0 END",
        "digits_jaccard": jaccard("d1", "d2", "1"), "first_digit_match": "CASE WHEN len(d1) > 0 AND len(d2) > 0 AND d1[1] = d2[1] THEN 1 ELSE 0 END", "name_len_diff": "abs(length(n1) - length(n2))",
        "name_len_ratio": "CASE WHEN greatest(length(n1), length(n2)) = 0 THEN 1 ELSE least(length(n1), length(n2)) / greatest(length(n1), length(n2)) END",
        "first_char_match": "CASE WHEN n1 <> '' AND n2 <> '' AND n1[1] = n2[1] THEN 1 ELSE 0 END", "is_source2": "CASE WHEN candidate_entity_id LIKE 'S2-%' THEN 1 ELSE 0 END", "house_conflict": HOUSE,
    }, ("a1", "a2"))


def mode_d(pairs: str, clean: str) -> str:
    return _features(pairs, clean, clean, {
        "name_ratio": "n.ratio / 100", "name_token_sort_ratio": "n.token_sort_ratio / 100", "name_token_set_ratio": "n.token_set_ratio / 100", "name_jaro_winkler": "n.jaro_winkler", "addr_ratio": "a.ratio / 100",
        "addr_token_sort_ratio": "a.token_sort_ratio / 100", "addr_jaro_winkler": "a.jaro_winkler", "full_ratio": "f.ratio / 100", "name_len_diff": relative_difference("n1", "n2"), "addr_len_diff": relative_difference("a1", "a2"),
    }, ("a1", "a2"), True)
