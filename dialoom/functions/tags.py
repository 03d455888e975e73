"""Guest tags, identities and topics from what is said, as Column expressions.

Cascades are ordered: the first keyword that the text holds decides.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dialoom.functions.scalars import first_match

# Keywords and their labels, in order of precedence.
EDUCATION = [("博士", "博士"), ("硕士", "硕士"), ("本科", "本科")]
PROFESSIONS = [
    ("医生", "医生"), ("医学", "医学"), ("工程师", "工程师"), ("程序员", "程序员"), ("教师", "教师"), ("老师", "老师"), ("高校", "高校老师"), ("律师", "律师"),
    ("设计师", "设计师"), ("产品", "产品"), ("运营", "运营"), ("销售", "销售"), ("创业", "创业"), ("金融", "金融"), ("咨询", "咨询"), ("主播", "主播"),
    ("瑜伽", "瑜伽"), ("体制内", "体制内"), ("经纪", "经纪"), ("博主", "博主"),
]
IDENTITIES = [("博士后", "博士后"), ("博士", "博士"), ("硕士", "硕士"), ("研究生", "硕士"), ("本科", "本科"), ("投资", "投资人"), ("媒体", "媒体人"), ("国企", "国企员工"), ("离异", "离异"), ("离婚", "离异")]
CITIES = ["北京", "上海", "广州", "深圳", "杭州", "成都", "南京", "武汉", "西安", "重庆"]
GREETINGS = ["你好", "哈喽"]
HOST_PHRASES = ["哈喽", "你好", "来下一个", "下一位", "拜拜", "欢迎", "谢谢"]
GOODBYES = ["拜拜", "谢谢", "再见"]
#: Ages that count, and the year from which a birth year is taken.
AGES, BORN_FROM = (18, 70), 2025


def two_digit_age(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(\d{2})岁", 1), F.lit(""))


def age(text: Column, low: int = AGES[0], high: int = AGES[1]) -> Column:
    """An age said as such, else by a birth year of two or four digits, within bounds."""
    said = two_digit_age(text).try_cast("int")
    year4 = F.regexp_extract(text, r"((?:19|20)\d{2})年(?:出生|的)", 1).try_cast("int")
    year2 = F.regexp_extract(text, r"(?<!\d)(\d{2})年(?:出生|的)", 1).try_cast("int")
    born = F.coalesce(year4, F.when(year2 > BORN_FROM % 100, 1900 + year2).otherwise(2000 + year2))
    value = F.coalesce(said, F.lit(BORN_FROM) - born)
    return F.when(value.between(low, high), value)


def guest_tag(text: Column) -> Column:
    """Age, education and first profession joined by ``_``; a general label where there is none."""
    parts = F.array_compact(F.array(F.concat(two_digit_age(text), F.lit("岁")), first_match(text, EDUCATION), first_match(text, PROFESSIONS)))
    return F.when(F.size(parts) > 0, F.array_join(parts, "_")).when(text.contains("女"), "女观众").otherwise("观众")


def identity(text: Column) -> Column:
    return first_match(text, IDENTITIES)


def labels(text: Column, most: int = 2) -> Column:
    """The first labels of professions that occur, in the list's order."""
    return F.slice(F.array_distinct(F.array_compact(F.array(*[F.when(text.contains(k), v) for k, v in PROFESSIONS]))), 1, most)


def city(text: Column) -> Column:
    return F.get(F.filter(F.array(*[F.lit(c) for c in CITIES]), lambda c: text.contains(c)), F.lit(0))


def income(text: Column) -> Column:
    """A yearly income in ten thousands."""
    return F.regexp_extract(text, r"年(?:入|薪|收入)(?:大概|差不多)?(\d+)(?:多)?万", 1).try_cast("int")


def any_of(text: Column, words: list[str]) -> Column:
    return F.exists(F.array(*[F.lit(w) for w in words]), lambda w: text.contains(w))
