"""Numeric features from effect texts, and the scoring model over them, as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Verbs, phrases and constants of the scoring model.
DOWN = r"(?:ダウン|を下|下降|低下|減少|降低|下げ|下)"
UP = r"(?:アップ|上昇|上がる|上升|提升|増)"
HEAL = ["回復", "回复", "治癒", "回血"]
IMMUNE = ["無効", "免疫", "不受影响"]
NO_RETREAT = ["撤退しない", "撤退しなく", "不会撤退"]
REVIVE = ["蘇生", "復活", "生き返", "复活"]
HARD_CONTROL = ["スタン", "魅了", "呪縛", "束縛", "眩晕", "魅惑", "束缚"]
CLEANSE = ["異常を回復", "異常状態を回復", "異常を治", "異常を取り除", "解除", "净化"]
SLOW = ["速度低下", "速度ダウン", "速度降低", "速度を下", "速度を減"]
# Phrases before or around a number, by what the number is. Those of the first group need a verb nearby.
DEFENCE_WORDS = ("防御", "攻防", "防速")
DEFENCE_LESS = r"防御.{0,10}?(\d+)%.{0,8}?(?:降低|下降|减少)"
ATTACK_MORE = r"攻撃力?.{0,12}?(\d+)%"
DAMAGE_DEALT, DAMAGE = r"与.{0,10}?ダメ.{0,14}?(\d+)%", r"ダメージ.{0,8}?(\d+)%"
DEFENCE_MORE = r"防御.{0,10}?(\d+)%"
SPEED_MORE = r"速度.{0,10}?(\d+)%"
CHARGES = (r"必殺.{0,6}?(?:ゲージ|値).{0,6}?(\d+)%", r"チャージ.{0,6}?(\d+)%", r"充能.{0,6}?(\d+)%")
ULTIMATE, ULTIMATE_POWER, EVERYONE = r"敵(単体|横一列|全体).{0,30}?(\d+)倍", r"必殺威力×(\d+)", "全体"
FEVER, CRIT, BREAK, REFERENCE_REDUCTION = 3.0, 1.25, 1.5, 0.50
ROCKET_SPEED, BELT_ATTACK, AWAKEN_ATTACK = 0.50, 0.50, 0.20
AWAKEN_SECONDS, AWAKEN_FLOOR, AWAKEN_CHARGE, CHARGE_CAP = 2.0, 3.0, 6.0, 15.0
COMBO_THRESHOLD = 60.0
UTILITY = {"revive": 100, "no_retreat": 60, "immune": 40, "heal": 35, "dec_cc": 30, "hardcc": 25, "guard": 30}
DAMAGE_SHARE, UTILITY_SHARE = 0.70, 0.30
WINDOW = 44


def plain(text: Column) -> Column:
    return F.replace(F.coalesce(text, F.lit("")), F.lit("％"), F.lit("%"))


def has_any(text: Column, patterns: list[str]) -> Column:
    return plain(text).rlike("(?iu)" + "|".join(f"(?:{p})" for p in patterns))


def largest_near(text: Column, pattern: str, verb: str) -> Column:
    """The largest number that ``pattern`` captures where ``verb`` is in the 44 characters from the match's start; 0 if none.

    An always-true look-ahead keeps the window without consuming it, so that matches follow each other as without it.
    """
    text = plain(text)
    whole = rf"(?d)(?=([\s\S]{{0,{WINDOW}}})){pattern}"
    near, numbers = F.regexp_extract_all(text, F.lit(whole), 1), F.regexp_extract_all(text, F.lit(whole), 2)
    hits = F.zip_with(near, numbers, lambda w, n: F.when(w.rlike(verb), n.cast("double")))
    return F.coalesce(F.array_max(hits), F.lit(0.0))


def largest(text: Column, pattern: str) -> Column:
    numbers = F.regexp_extract_all(plain(text), F.lit(f"(?d){pattern}"), 1)
    return F.coalesce(F.array_max(F.transform(numbers, lambda n: n.cast("double"))), F.lit(0.0))


def defence_down(text: Column) -> Column:
    parts = [largest_near(text, rf"{word}.{{0,16}}?(\d+)%", DOWN) for word in DEFENCE_WORDS]
    return F.least(F.lit(1.0), F.greatest(*parts, largest(text, DEFENCE_LESS)) / 100)


def attack_up(text: Column) -> Column:
    return largest_near(text, ATTACK_MORE, UP) / 100


def damage_up(text: Column) -> Column:
    return F.greatest(*(largest_near(text, p, UP) for p in (DAMAGE_DEALT, DAMAGE))) / 100


def guard(text: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(largest_near(text, DEFENCE_MORE, UP), largest_near(text, DAMAGE_DEALT, DOWN)) / 100)


def speed_up(text: Column) -> Column:
    return largest_near(text, SPEED_MORE, UP) / 100


def charge_up(text: Column) -> Column:
    return F.greatest(*(largest(text, p) for p in CHARGES)) / 100


def ultimate(text: Column) -> Column:
    """(mult, aoe, target): the largest multiplier; whether any hits all; the last target."""
    form = F.lit(f"(?d){ULTIMATE}")
    targets, numbers = F.regexp_extract_all(plain(text), form, 1), F.regexp_extract_all(plain(text), form, 2)
    mult = F.greatest(F.coalesce(F.array_max(F.transform(numbers, lambda n: n.cast("double"))), F.lit(0.0)), largest(text, ULTIMATE_POWER))
    return F.struct(mult.alias("mult"), F.array_contains(targets, EVERYONE).alias("aoe"), F.coalesce(F.try_element_at(targets, F.lit(-1)), F.lit("")).alias("target"))


def awakened_interval(seconds: Column) -> Column:
    return F.greatest(seconds - AWAKEN_SECONDS, F.lit(AWAKEN_FLOOR), F.lit(0.1))


def awakened_charge(percent: Column) -> Column:
    return F.when(percent >= CHARGE_CAP, percent).otherwise(F.least(percent + AWAKEN_CHARGE, F.lit(CHARGE_CAP)))


def combo_multiplier(rate: Column) -> Column:
    p = F.least(rate, F.lit(0.95))
    extra = p * 0.8 + F.pow(p, F.lit(2)) * 0.6 + F.pow(p, F.lit(3)) * 0.4 + F.lit(0.3) * F.pow(p, F.lit(4)) / (1 - p)
    return F.when(p <= 0, F.lit(1.0)).otherwise(1 + extra)


def damage_rates(base, combo_rate, action_speed, ult_charge, ult_mult, attack, damage, reduction, hard_control, self_speed) -> tuple[Column, Column]:
    """Damage a second by plain attacks and by ultimates."""
    interval = awakened_interval(action_speed) * (1 - ROCKET_SPEED) / (1 + self_speed) * (1 + combo_rate)
    hit = base * (1 + AWAKEN_ATTACK) * (1 + attack + BELT_ATTACK) * (1 + damage) * reduction
    broken = F.when(hard_control, F.lit(BREAK)).otherwise(F.lit(1.0))
    normal = (hit * CRIT + hit * (combo_multiplier(combo_rate) - 1)) * (F.lit(1.0) / interval)
    special = hit * ult_mult * FEVER * broken * (awakened_charge(ult_charge) / 100 / interval)
    return normal, special


def solo_reduction(defence_down: Column) -> Column:
    return F.lit(1.0) - REFERENCE_REDUCTION * (1 - F.least(F.lit(1.0), defence_down))


def utility_score(flags: dict[str, Column]) -> Column:
    return reduce(lambda a, b: a + b, (F.lit(float(w)) * flags[k].cast("double") for k, w in UTILITY.items()))


def tier(position: Column, total: Column) -> Column:
    """By (rank - 1) / n: under .10 T0, under .30 T1, under .60 T2, else T3."""
    share = (position - 1) / total
    return F.when(share < 0.10, "T0").when(share < 0.30, "T1").when(share < 0.60, "T2").otherwise("T3")


def fit(boss: Column, flags: dict[str, Column]) -> Column:
    """What a team's flags make of its damage against each boss (fixed values)."""
    one = F.lit(1.0)
    return (
        F.when(boss == "乌塔尔", F.when(flags["aoe"], one).otherwise(0.60))
        .when(boss == "狂王", F.when(flags["aoe"], one).otherwise(0.70))
        .when(boss == "堕威大佛", F.when(flags["hardcc"] | flags["aoe"], one).otherwise(0.70))
        .when(boss == "大往女", F.when(flags["immune"] | flags["dec_cc"], one).otherwise(0.80))
        .when(boss == "古纳冈", F.when(flags["heal"], one).otherwise(0.65))
        .when(boss == "弗栗多", one + F.when(flags["slow"], 0.10).otherwise(0.0) + F.when(flags["no_retreat"], 0.05).otherwise(0.0))
        .otherwise(one)
    )


#: The share of damage that each boss takes off.
BOSSES = {"黄金甜心": 0.50, "古纳冈": 0.50, "乌塔尔": 0.65, "堕威大佛": 0.60, "大往女": 0.60, "狂王": 0.60, "弗栗多": 0.75}


def primary_class(ult_mult: Column, survival: Column, support: Column) -> Column:
    return F.when(ult_mult > 0, "输出").when(survival, "生存").when(support, "辅助").otherwise("其他")


def output_class(primary: Column, combo_percent: Column, target: Column) -> Column:
    by_target = F.when(target == "単体", "単体").when(target == "横一列", "横列").when(target == "全体", "全体").otherwise("其他")
    return F.when(primary != "输出", "").when(F.coalesce(combo_percent, F.lit(0.0)) >= COMBO_THRESHOLD, "連撃").otherwise(by_target)


def labels(text: Column, table: dict[str, list[str]]) -> Column:
    """All labels one of whose phrases the text holds, whatever the case, in the table's order."""
    low = F.lower(text)
    one = [F.when(reduce(lambda a, b: a | b, (F.contains(low, F.lit(k.lower())) for k in keys)), F.lit(name)) for name, keys in table.items()]
    return F.array_compact(F.array(*one))


def pattern_labels(text: Column, table: dict[str, str]) -> Column:
    return F.array_compact(F.array(*[F.when(text.rlike(f"(?iu){p}"), F.lit(name)) for name, p in table.items()]))
