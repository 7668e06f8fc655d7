"""Teams: greedy cover of roles, scores, and aggregates against bosses."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import features as X

# Roles that a team must have, weights of rare roles, roles that complete survival.
MANDATORY = ["输出", "降防", "速度", "充能", "治疗"]
SURVIVAL = ["免疫", "减伤", "不撤退", "复活"]
RARE = {"降防": 5, "充能": 4, "速度": 4, "免疫": 6, "不撤退": 7, "复活": 8, "解控": 3, "减伤": 3, "硬控": 2}
GAIN = {**RARE, "攻buff": 1}
SIZE = 5


def greedy_cover(candidates: list[tuple[str, str, set[str]]], must: list[str], gain: dict[str, float], size: int = SIZE, low_first: bool = False) -> list[str]:
    """Names in the order taken from (name, rarity, roles).

    First whoever adds a mandatory role, by most new roles, then most roles, then rarity, then name; then whoever adds
    most by weight plus half a point a new role, ties by name.
    """
    rarity = ["R", "SR", "SSR"] if low_first else ["SSR", "SR", "R"]
    place = {r: i for i, r in enumerate(rarity)}
    team: list[str] = []
    covered: set[str] = set()
    left = {n: (r, roles) for n, r, roles in candidates}
    while left and len(team) < size:
        useful = [n for n, (_, roles) in left.items() if any(m in roles and m not in covered for m in must)]
        if useful:
            best = min(useful, key=lambda n: (-len(left[n][1] - covered), -len(left[n][1]), place.get(left[n][0], 3), n))
        else:
            best = min(left, key=lambda n: (-(sum(gain.get(r, 0) for r in left[n][1] - covered) + 0.5 * len(left[n][1] - covered)), n))
        team.append(best)
        covered |= left.pop(best)[1]
    return team


def distinct_profiles(entities: DataFrame, size: int = SIZE) -> DataFrame:
    """Only the first names of each (rarity, roles) can be taken: equal profiles differ by name alone. This bounds what
    the greedy step sees by the number of profiles, not of entities. ``entities``: name, rarity, roles (array)."""
    profile = entities.withColumn("roles", F.array_sort(F.array_distinct("roles")))
    first = profile.groupBy("rarity", "roles").agg(F.slice(F.array_sort(F.collect_set("name")), 1, size).alias("names"))
    return first.select(F.explode("names").alias("name"), "rarity", "roles")


def greedy_team(entities: DataFrame, must: list[str] | None = None, gain: dict[str, float] | None = None, low_first: bool = False, size: int = SIZE) -> DataFrame:
    """(slot, name): one small group, in one Python task."""
    must, gain = MANDATORY if must is None else must, GAIN if gain is None else gain

    def pick(batch: pd.DataFrame) -> pd.DataFrame:
        team = greedy_cover([(n, r, set(x)) for n, r, x in zip(batch["name"], batch["rarity"], batch["roles"], strict=True)], must, gain, size, low_first)
        return pd.DataFrame({"slot": pd.Series(range(1, len(team) + 1), dtype="int64"), "name": pd.Series(team, dtype="object")})

    return distinct_profiles(entities, size).withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(pick, "slot long, name string")


def team_score(members: DataFrame) -> DataFrame:
    """(team, mandatory, survives, covered, weight) of teams' members (team, roles)."""
    union = members.select("team", F.explode_outer("roles").alias("role")).groupBy("team").agg(F.collect_set("role").alias("roles"))  # as many as there are roles
    listed = lambda names: F.array(*[F.lit(n) for n in names])
    weights = F.create_map(*[F.lit(x) for pair in RARE.items() for x in pair])
    return union.select(
        "team",
        F.size(F.array_intersect("roles", listed(MANDATORY))).alias("mandatory"),
        (F.array_contains("roles", "治疗") & F.arrays_overlap("roles", listed(SURVIVAL))).cast("int").alias("survives"),
        F.size("roles").alias("covered"),
        F.aggregate("roles", F.lit(0), lambda n, r: n + F.coalesce(F.try_element_at(weights, r), F.lit(0))).alias("weight"),
    )


MAX_BOSSES = 1000
FLAGS = ["heal", "immune", "no_retreat", "revive", "aoe", "hardcc", "dec_cc", "slow"]


def against_bosses(members: DataFrame, bosses: DataFrame) -> DataFrame:
    """(team, boss, damage, score, rank): every team against every boss, in the order of score and team.

    ``members``: team and the columns of an entity's kit; ``bosses``: boss, reduction (a handful of rows).
    """
    if bosses.limit(MAX_BOSSES + 1).count() > MAX_BOSSES:
        raise ValueError(f"over {MAX_BOSSES} bosses: every team meets every boss")
    whole = members.groupBy("team").agg(F.max("def_down").alias("t_def"), F.max("atk_buff").alias("t_atk"), F.max("dmg_up").alias("t_dmg"), *[F.bool_or(f).alias(f"t_{f}") for f in FLAGS])
    each = members.join(whole, "team").join(F.broadcast(bosses), how="cross")
    reduction = F.lit(1.0) - F.col("reduction") * (1 - F.least(F.lit(1.0), F.col("t_def")))
    normal, special = X.damage_rates(F.col("base"), F.col("combo_rate"), F.col("action_speed"), F.col("ult_charge"), F.col("ult_mult"), F.col("t_atk"), F.col("t_dmg"), reduction, F.col("t_hardcc"), F.col("self_speed"))
    flags = [F.first(f"t_{f}").alias(f) for f in FLAGS]
    total = each.withColumn("_d", normal + special).groupBy("team", "boss").agg(F.sum("_d").alias("damage"), *flags)
    scored = total.withColumn("score", F.col("damage") * X.fit(F.col("boss"), {f: F.col(f) for f in FLAGS}))
    from .order import top_per_group

    return top_per_group(scored.select("team", "boss", "damage", "score"), ["boss"], [F.col("score").desc(), F.col("team")], 1 << 30)


def rank_sums(results: DataFrame) -> DataFrame:
    return results.groupBy("team").agg(F.sum(F.col("rank") - 1).alias("rank_sum"), F.avg("score").alias("mean_score"))

