"""Entity analytics: flat records, kits, classes, scores, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import features as X
from ..functions.text import digits_only, first_match, number_before
from ..operators.joins import as_of_level
from ..operators.order import label_pairs, pivot_with_total, tiers, top_per_group

# Synonyms, phrases and labels of the reports.
ATTACK_KINDS = {
    "近战物理攻击": "近战物理", "近战攻击（物理）": "近战物理", "近距离（物理）": "近战物理", "远程物理攻击": "远程物理",
    "远程攻击（物理）": "远程物理", "长途（物理距离）": "远程物理", "远程魔法攻击": "远程魔法", "近战魔法攻击": "近战魔法",
}
OBTAIN = [("交換所", "交换所"), ("ガチャ", "卡池"), ("ストーリー", "剧情"), ("配布", "赠送"), ("イベント", "活动"), ("限定", "限定"), ("常設", "常驻"), ("ミッション", "任务")]
TAGS = {
    "不撤退": ["撤退しない", "撤退しなく", "退場しない", "撤退しなくなる", "不会撤退"],
    "体力维持": ["スタミナ", "体力", "ST", "持続", "減少を防", "減少を抑", "低下を防"],
    "全异常免疫": ["全ての異常", "すべての異常", "全异常免疫", "あらゆる異常", "全部异常"],
    "魅惑免疫": ["魅惑", "魅了"],
    "束缚免疫": ["束縛", "呪縛"],
    "眩晕免疫": ["眩晕", "晕眩"],
    "异常解除": ["異常を回復", "異常を治", "異常状態を回復", "解除", "異常を取り除"],
    "速度辅助": ["行動速度", "スピード", "速度", "行動間隔", "クイック"],
    "充能辅助": ["必殺ゲージ", "必殺技ゲージ", "ゲージ", "チャージ", "充能", "必杀槽", "必殺技の溜", "必殺技を溜"],
    "攻击buff": ["攻撃力", "攻撃上昇", "攻撃力アップ", "与えるダメージ", "攻撃力を上", "伤害上升", "攻击力上升"],
    "魔法buff": ["魔法力", "魔法上昇", "魔法力アップ", "魔法力を上", "魔法力上升"],
    "防御buff": ["防御力", "防御上昇", "防御力アップ", "防御力を上", "防御力上升"],
    "伤害减buff": ["受けるダメージ", "ダメージを軽減", "被ダメージ", "伤害减轻", "受到伤害", "ダメージカット", " damage cut"],
    "防御debuff": ["防御力ダウン", "防御力を下", "防御力下降", "防御力を減", "防御力を引"],
    "魔抗debuff": ["魔法抵抗力ダウン", "魔法抵抗力を下", "魔法抵抗下降", "魔法抵抗を下"],
    "治疗": ["体力を回復", "回復", "回復する", "治癒", "回復させ", "体力回復", "回复"],
    "即死": ["即死", "瞬殺"],
    "防御无视": ["防御無視", "防御を無視", "防御力を無視", "防御无视"],
    "暴击": ["クリティカル", "暴击", "会心"],
    "连击": ["連撃", "コンボ", "连击"],
    "AoE全体": ["全体", "全員", "全ての敵", "范围内", "範囲"],
    "贯通/破防": ["貫通", "贯通", "ブレイク", "break", "Break"],
    "复活": ["蘇生", "復活", "生き返", "复活"],
    "吸血": ["吸収", "吸血"],
    "分身/召唤": ["分身", "召喚", "シンクロ", "召唤"],
    "必定hit": ["必中", "命中率", "回避無視", "回避を無視"],
    "属性特攻": ["太陽", "月", "星", "太阳", "月球", "星星"],
}
ROLES = {
    "降防": r"防御.{0,6}(ダウン|を下|を減|下降|低下|減少)|攻防.{0,6}(ダウン|を下)|防速.{0,6}ダウン|降低防御|降低敌方防御|敵の防御",
    "攻buff": r"攻撃力?.{0,8}(アップ|上昇|上がる|を上|上升|提升)|攻击力提升|攻击力上升",
    "增伤": r"与ダメ.{0,6}アップ|与えるダメージ.{0,6}(アップ|上昇)|伤害提升|增伤|ダメージ上昇",
    "速度": r"行動速度|スピード|速度|行動間隔|クイック|素早さ|攻击速度|行動を早",
    "充能": r"必殺ゲージ|必殺技ゲージ|必殺値|チャージ|充能|必殺技の溜|必殺技を溜|ゲージを上|必杀槽",
    "治疗": r"体力を回復|回復|回復する|治癒|回復させ|体力回復|回复|回血",
    "减伤": r"受けるダメージ|ダメージを軽減|被ダメージ|ダメージカット|ダメージ軽減|受到伤害|伤害减轻|伤害减少|防御.{0,6}(アップ|上昇)|与ダメ.{0,6}ダウン|攻防.{0,6}ダウン",
    "免疫": r"全ての異常|すべての異常|全异常|あらゆる異常|免疫|無効|不受影响",
    "解控": r"異常を回復|異常状態を回復|異常を治|異常を取り除|状態異常を回復|解除|净化",
    "不撤退": r"撤退しない|撤退しなく|退場しない|撤退しなくなる|不会撤退",
    "复活": r"蘇生|復活|生き返|复活|蘇",
    "硬控": r"スタン|眩晕|晕眩|魅了|魅惑|呪縛|束縛|束缚",
}
OUTPUT_ROLE, HIGH_STAT, HIGH_MULTIPLIER = "输出", 450, 3
STATS = ["スタミナ", "攻撃力", "防御力", "魔法力", "魔法抵抗力"]
LEVEL, TARGET_LEVEL = "レベル", 100


def translated(cell: Column) -> Column:
    """A cell's translation, else its text."""
    return F.trim(F.coalesce(F.when(cell["zh"] != "", cell["zh"]), cell["t"], F.lit("")))


def table_rows(sections: DataFrame, section: str) -> DataFrame:
    """(name, ord, header, cells): a section's rows below its first, with the first row's texts; at least two rows."""
    rows = sections.select("name", F.col("sections")[section]["rows"].alias("_rows")).filter(F.size("_rows") >= 2)
    header = F.transform(F.get("_rows", F.lit(0)), lambda c: F.trim(F.coalesce(c["t"], F.lit(""))))
    return rows.select("name", header.alias("header"), F.posexplode(F.slice("_rows", 2, 1 << 30)).alias("ord", "cells"))


def column(name: str) -> Column:
    """The cell under a heading."""
    return F.get("cells", F.array_position("header", name).cast("int") - 1)


def level_stats(sections: DataFrame, section: str = "基本ステータス", stats: list[str] = STATS) -> DataFrame:
    """(name, level, stats): the row of the greatest level up to 100, else of the greatest."""
    rows = table_rows(sections, section).withColumn("level", F.regexp_extract(column(LEVEL)["t"], r"\d+", 0)).filter("level <> ''")
    values = F.create_map(*[x for s in stats for x in (F.lit(s), digits_only(translated(column(s))))])
    picked = rows.select("name", F.col("level").cast("int").alias("level"), "ord", values.alias("stats"))
    return as_of_level(picked, ["name"], "level", "ord", TARGET_LEVEL).select("name", "level", "stats")


def effects(sections: DataFrame, section: str) -> DataFrame:
    """(name, effects): a table's name and effect cells in both languages, in order."""
    rows = table_rows(sections, section).filter(F.array_contains("header", "名称") & F.array_contains("header", "効果"))
    one = F.struct("ord", F.coalesce(column("名称")["t"], F.lit("")).alias("name_ja"), translated(column("名称")).alias("name_zh"), F.coalesce(column("効果")["t"], F.lit("")).alias("eff_ja"), translated(column("効果")).alias("eff_zh"))
    return rows.groupBy("name").agg(F.transform(F.array_sort(F.collect_list(one)), lambda e: F.struct(e["name_ja"].alias("name_ja"), e["name_zh"].alias("name_zh"), e["eff_ja"].alias("eff_ja"), e["eff_zh"].alias("eff_zh"))).alias("effects"))


def combat(sections: DataFrame, section: str = "詳細ステータス") -> DataFrame:
    """(name, combat, raw): combo rate %, seconds an action, ultimate charge % from label and value cells."""
    cells = sections.select("name", F.flatten(F.col("sections")[section]["rows"]).alias("_cells"))
    pairs = label_pairs(F.transform("_cells", lambda c: F.struct(F.coalesce(c["h"], F.lit(False)).alias("h"), F.when(c["h"], translated(c)).otherwise(c["t"]).alias("t"))))
    rows = cells.withColumn("raw", pairs)
    value = lambda label: F.try_element_at(F.col("raw"), F.lit(label))
    return rows.select("name", F.struct(number_before(value("连击率"), "%").alias("combo_rate"), number_before(value("行动速度"), "sec").alias("action_speed_sec"), number_before(value("必杀充能效率"), "%").alias("ult_charge")).alias("combat"), "raw")


def profile(sections: DataFrame) -> DataFrame:
    """(name, faction, atk_type) from the profile's label and value rows; of equal labels the last counts."""
    rows = F.col("sections")["プロフィール"]["rows"]
    pair = lambda label: F.element_at(F.filter(rows, lambda r: (F.size(r) >= 2) & (F.trim(r[0]["t"]) == label)), -1)[1]
    kinds = F.create_map(*[F.lit(x) for p in ATTACK_KINDS.items() for x in p])
    attack = translated(pair("通常攻撃"))
    return sections.select("name", F.coalesce(translated(pair("所属勢力")), F.lit("")).alias("faction"), F.coalesce(F.try_element_at(kinds, attack), attack, F.lit("")).alias("atk_type"))


def flat_records(sections: DataFrame) -> DataFrame:
    """One analytic record an entity."""
    first = F.get(F.get(F.col("sections")["入手方法"]["rows"], F.lit(1)), F.lit(0))
    base = sections.select("name", "rarity", F.coalesce(translated(first), F.lit("")).alias("obtain"))
    for part in (profile(sections), level_stats(sections), combat(sections), effects(sections, "必殺技").withColumnRenamed("effects", "ultimates"), effects(sections, "固有効果").withColumnRenamed("effects", "uniques")):
        base = base.join(part, "name", "left")
    return base


def kit_text(*effects: str) -> Column:
    both = lambda e: F.concat_ws(" ", F.coalesce(e["eff_ja"], F.lit("")), F.coalesce(e["eff_zh"], F.lit("")))
    return F.array_join(F.flatten(F.array(*[F.coalesce(F.transform(e, both), F.array().cast("array<string>")) for e in effects])), " ")


def kits(records: DataFrame, text: Column | None = None) -> DataFrame:
    """Features of each record. ``records``: name, rarity, attack, magic, combat, and ultimates and uniques or ``text``."""
    text = kit_text("ultimates", "uniques") if text is None else text
    t, ult = F.col("_text"), F.col("_ult")
    combo = F.coalesce(F.col("combat.combo_rate"), F.lit(0.0))
    speed = F.col("combat.action_speed_sec")
    charge = F.col("combat.ult_charge")
    return records.withColumn("_text", text).withColumn("_ult", X.ultimate(F.col("_text"))).select(
        "name", "rarity", F.greatest(F.coalesce("attack", F.lit(0)), F.coalesce("magic", F.lit(0))).cast("double").alias("base"),
        F.when(ult["mult"] == 0, F.lit(1.0)).otherwise(ult["mult"]).alias("ult_mult"), (ult["mult"] > 0).alias("has_ult"), ult["aoe"].alias("aoe"), ult["target"].alias("target"),
        X.defence_down(t).alias("def_down"), X.attack_up(t).alias("atk_buff"), X.damage_up(t).alias("dmg_up"), X.guard(t).alias("guard"), X.speed_up(t).alias("self_speed"), X.charge_up(t).alias("charge"),
        (combo / 100).alias("combo_rate"), combo.alias("combo_percent"),
        F.when(F.coalesce(speed, F.lit(0.0)) == 0, 5.0).otherwise(speed).alias("action_speed"), F.when(F.coalesce(charge, F.lit(0.0)) == 0, 7.5).otherwise(charge).alias("ult_charge"),
        X.has_any(t, X.HEAL).alias("heal"), X.has_any(t, X.IMMUNE).alias("immune"), X.has_any(t, X.NO_RETREAT).alias("no_retreat"), X.has_any(t, X.REVIVE).alias("revive"),
        X.has_any(t, X.HARD_CONTROL).alias("hardcc"), X.has_any(t, X.CLEANSE).alias("dec_cc"), X.has_any(t, X.SLOW).alias("slow"),
    )


def scored(kit: DataFrame) -> DataFrame:
    """Kits with damage a second, utility, strength (0.7 and 0.3 of the shares of the best), rank and tier."""
    normal, special = X.damage_rates(F.col("base"), F.col("combo_rate"), F.col("action_speed"), F.col("ult_charge"), F.col("ult_mult"), F.col("atk_buff"), F.col("dmg_up"), X.solo_reduction(F.col("def_down")), F.col("hardcc"), F.col("self_speed"))
    rated = kit.withColumn("normal_dps", normal).withColumn("ult_dps", special).withColumn("dps", F.col("normal_dps") + F.col("ult_dps"))
    rated = rated.withColumn("utility", X.utility_score({k: F.col(k) for k in X.UTILITY})).withColumn("ult_share", F.col("ult_dps") / F.nullif("dps", F.lit(0.0)))
    most = rated.agg(F.max("dps").alias("_d"), F.max("utility").alias("_u"))
    both = rated.join(F.broadcast(most))  # one row
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b) * 100).otherwise(0.0)
    both = both.withColumn("dps_share", share("dps", "_d")).withColumn("utility_share", share("utility", "_u"))
    return tiers(both.withColumn("strength", X.DAMAGE_SHARE * F.col("dps_share") + X.UTILITY_SHARE * F.col("utility_share")).drop("_d", "_u"), "strength", "name")


def classified(kit: DataFrame) -> DataFrame:
    survival = F.col("heal") | F.col("immune") | F.col("no_retreat") | F.col("revive") | (F.col("guard") > 0)
    support = (F.col("atk_buff") > 0) | (F.col("def_down") > 0) | (F.col("self_speed") > 0) | (F.col("charge") > 0)
    rows = kit.withColumn("primary", X.primary_class(F.col("has_ult").cast("int"), survival, support))
    return rows.withColumn("sub", X.output_class(F.col("primary"), F.col("combo_percent"), F.col("target")))


def with_roles(records: DataFrame, text: Column | None = None) -> DataFrame:
    """Roles by pattern, and the output role for high stats, a multiplier of 3 or more, or combos."""
    text = kit_text("uniques", "ultimates") if text is None else text
    rows = records.withColumn("_text", text)
    times = F.regexp_extract("_text", r"×(\d+)", 1)
    high = (F.coalesce("attack", F.lit(0)) >= HIGH_STAT) | (F.coalesce("magic", F.lit(0)) >= HIGH_STAT)
    output = high | ((times != "") & (times.cast("long") >= HIGH_MULTIPLIER)) | F.contains("_text", F.lit("連撃")) | F.contains("_text", F.lit("回攻"))
    roles = F.array_sort(F.concat(X.pattern_labels(F.col("_text"), ROLES), F.when(output, F.array(F.lit(OUTPUT_ROLE))).otherwise(F.array().cast("array<string>"))))
    return rows.withColumn("roles", roles).drop("_text")


def tags(records: DataFrame, text: Column | None = None) -> DataFrame:
    return records.withColumn("tags", X.labels(kit_text("uniques", "ultimates") if text is None else text, TAGS))


def short_obtain(text: Column) -> Column:
    bare = F.trim(F.coalesce(text, F.lit("")))
    return F.when(bare == "", "?").otherwise(first_match(bare, OBTAIN, F.substring(bare, 1, 8)))


def leaderboard(records: DataFrame, stats: list[str], k: int = 20) -> DataFrame:
    """(stat, rank, name, value): the first ``k`` of each stat; missing values don't count."""
    long = records.select("name", F.explode(F.create_map(*[x for s in stats for x in (F.lit(s), F.col(f"`{s}`"))])).alias("stat", "value")).filter("value IS NOT NULL")
    return top_per_group(long, ["stat"], [F.col("value").desc(), F.col("name")], k).select("stat", "rank", "name", "value")


def role_scarcity(records: DataFrame, rarities: list[str]) -> DataFrame:
    return pivot_with_total(records.select(F.explode("roles").alias("role"), "rarity"), "role", "rarity", rarities)


def tier_table(scores: DataFrame, rarities: list[str]) -> DataFrame:
    return pivot_with_total(scores, "tier", "rarity", rarities)


def feature_line() -> Column:
    """What stands out in a kit, in words."""
    percent = lambda c: F.concat(F.round(F.col(c) * 100).cast("int").cast("string"), F.lit("%"))
    parts = [
        F.when(F.col("def_down") > 0, F.concat(F.lit("降防"), percent("def_down"))), F.when(F.col("ult_mult") >= 6, F.concat(F.lit("必杀×"), F.col("ult_mult").cast("int").cast("string"))),
        F.when(F.col("atk_buff") > 0, F.concat(F.lit("攻"), percent("atk_buff"))), F.when(F.col("dmg_up") > 0, F.concat(F.lit("增"), percent("dmg_up"))),
        F.when(F.col("combo_percent") >= X.COMBO_THRESHOLD, F.concat(F.lit("连击"), percent("combo_rate"))),
        *[F.when(F.col(c), F.lit(name)) for c, name in (("revive", "复活"), ("no_retreat", "不撤"), ("immune", "免疫"), ("heal", "奶"), ("hardcc", "硬控"))],
    ]
    return F.concat_ws(" ", *parts)


def top_list(scores: DataFrame, k: int = 40) -> DataFrame:
    return scores.filter(F.col("rank") <= k).select("rank", "name", "rarity", "strength", "tier", "dps_share", "utility_share", feature_line().alias("features")).orderBy("rank")
