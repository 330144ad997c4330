"""Pair features of the modes, from pairs that hold both sides' name and address."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import similarity as sim
from tessera.functions import text

# The names and order of the feature columns.
MODE_A = (
    "name_token_sort_ratio", "name_wratio", "name_partial_ratio", "address_token_set_ratio", "address_token_sort_ratio", "address_levenshtein",
    "number_overlap", "len_diff_name", "len_diff_addr", "blocking_rank", "name_token_overlap", "addr_token_overlap", "veto_flag",
)
MODE_B = (
    "name_ratio", "name_partial_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_jaro_winkler", "addr_ratio", "addr_token_set_ratio",
    "addr_partial_ratio", "addr_is_null_s1", "addr_is_null_cand", "digits_jaccard", "first_digit_match", "name_len_diff", "name_len_ratio",
    "first_char_match", "is_source2", "house_conflict",
)
MODE_D = (
    "name_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_jaro_winkler", "addr_ratio", "addr_token_sort_ratio", "addr_jaro_winkler",
    "full_ratio", "name_len_diff", "addr_len_diff",
)


def with_sides(pairs: DataFrame, left: DataFrame, right: DataFrame, inner: bool = False) -> DataFrame:
    """pairs (source1_entity_id, candidate_entity_id, ...) with s1_name, s1_address, c_name, c_address; empty where an id is unknown or a value null. inner: pairs with an unknown candidate are left out."""
    return with_side(with_side(pairs, left, "source1_entity_id", "s1"), right, "candidate_entity_id", "c", inner)


def with_side(rows: DataFrame, entities: DataFrame, key: str, prefix: str, inner: bool = False) -> DataFrame:
    """rows with the name and address of the entities that their column key names."""
    side = entities.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"{prefix}_name"), F.col("business_address").alias(f"{prefix}_address"))
    got = rows.join(side, key, "inner" if inner else "left")
    return got.select(*rows.columns, *[F.coalesce(c, F.lit("")).alias(c) for c in (f"{prefix}_name", f"{prefix}_address")])


def _select(pairs: DataFrame, columns: dict[str, Column], order: tuple[str, ...]) -> DataFrame:
    keep = [c for c in pairs.columns if c not in ("s1_name", "s1_address", "c_name", "c_address", *order)]
    return pairs.select(*keep, *[F.round(columns[n].cast("double"), 6).alias(n) for n in order])


def mode_a(pairs: DataFrame) -> DataFrame:
    """13 features on lower-case trimmed text; ratios are percentages. pairs has blocking_rank."""
    n1, n2, a1, a2 = (text.feature_text(c) for c in ("s1_name", "c_name", "s1_address", "c_address"))
    both1, both2 = F.concat_ws(" ", n1, a1), F.concat_ws(" ", n2, a2)
    number = lambda c: F.array_distinct(text.digits(c))
    token = lambda c: F.array_distinct(text.tokens(c, 1))
    return _select(pairs, {
        "name_token_sort_ratio": sim.column_of("token_sort_ratio")(n1, n2), "name_wratio": sim.column_of("wratio")(n1, n2), "name_partial_ratio": sim.column_of("partial_ratio")(n1, n2),
        "address_token_set_ratio": sim.column_of("token_set_ratio")(a1, a2), "address_token_sort_ratio": sim.column_of("token_sort_ratio")(a1, a2), "address_levenshtein": sim.levenshtein_percent(a1, a2),
        "number_overlap": sim.number_overlap(number(both1), number(both2)), "len_diff_name": sim.relative_length_difference(n1, n2), "len_diff_addr": sim.relative_length_difference(a1, a2),
        "blocking_rank": F.col("blocking_rank"), "name_token_overlap": sim.set_jaccard(token(n1), token(n2), 1.0), "addr_token_overlap": sim.set_jaccard(token(a1), token(a2), 1.0),
        "veto_flag": sim.veto(number(both1), number(both2)),
    }, MODE_A)


def mode_b(pairs: DataFrame, fold: bool = True) -> DataFrame:
    """17 features on text cleaned as in mode B; ratios from 0 to 1. Address similarities are 0 where an address is empty."""
    n1, n2 = text.clean_name("s1_name", fold), text.clean_name("c_name", fold)
    a1, a2 = text.clean_address("s1_address", fold), text.clean_address("c_address", fold)
    pairs = pairs.withColumns({"_n1": n1, "_n2": n2, "_a1": a1, "_a2": a2})
    n1, n2, a1, a2 = (F.col(c) for c in ("_n1", "_n2", "_a1", "_a2"))
    d1, d2 = text.digits(a1), text.digits(a2)
    there = (a1 != "") & (a2 != "")
    part = lambda kind, a, b: sim.column_of(kind)(a, b) / 100
    got = _select(pairs, {
        "name_ratio": part("ratio", n1, n2), "name_partial_ratio": part("partial_ratio", n1, n2), "name_token_sort_ratio": part("token_sort_ratio", n1, n2),
        "name_token_set_ratio": part("token_set_ratio", n1, n2), "name_jaro_winkler": sim.column_of("jaro_winkler")(n1, n2),
        "addr_ratio": F.when(there, part("ratio", a1, a2)).otherwise(0.0), "addr_token_set_ratio": F.when(there, part("token_set_ratio", a1, a2)).otherwise(0.0),
        "addr_partial_ratio": F.when(there, part("partial_ratio", a1, a2)).otherwise(0.0), "addr_is_null_s1": F.when(a1 == "", 1.0).otherwise(0.0), "addr_is_null_cand": F.when(a2 == "", 1.0).otherwise(0.0),
        "digits_jaccard": sim.digits_jaccard(F.array_distinct(d1), F.array_distinct(d2)), "first_digit_match": sim.first_digit_match(d1, d2),
        "name_len_diff": F.abs(F.length(n1) - F.length(n2)), "name_len_ratio": sim.length_ratio(n1, n2), "first_char_match": sim.first_char_match(n1, n2),
        "is_source2": F.when(F.col("candidate_entity_id").startswith("S2-"), 1.0).otherwise(0.0), "house_conflict": sim.house_conflict(d1, d2),
    }, MODE_B)
    return got.drop("_n1", "_n2", "_a1", "_a2")


def mode_d(pairs: DataFrame) -> DataFrame:
    """10 features on text with company forms spelt out; ratios from 0 to 1."""
    n1, n2, a1, a2 = (text.clean_expanded(c) for c in ("s1_name", "c_name", "s1_address", "c_address"))
    pairs = pairs.withColumns({"_n1": n1, "_n2": n2, "_a1": a1, "_a2": a2})
    n1, n2, a1, a2 = (F.col(c) for c in ("_n1", "_n2", "_a1", "_a2"))
    part = lambda kind, a, b: sim.column_of(kind)(a, b) / 100
    got = _select(pairs, {
        "name_ratio": part("ratio", n1, n2), "name_token_sort_ratio": part("token_sort_ratio", n1, n2), "name_token_set_ratio": part("token_set_ratio", n1, n2),
        "name_jaro_winkler": sim.column_of("jaro_winkler")(n1, n2), "addr_ratio": part("ratio", a1, a2), "addr_token_sort_ratio": part("token_sort_ratio", a1, a2),
        "addr_jaro_winkler": sim.column_of("jaro_winkler")(a1, a2), "full_ratio": part("ratio", F.concat_ws(" ", n1, a1), F.concat_ws(" ", n2, a2)),
        "name_len_diff": sim.relative_length_difference(n1, n2), "addr_len_diff": sim.relative_length_difference(a1, a2),
    }, MODE_D)
    return got.drop("_n1", "_n2", "_a1", "_a2")
