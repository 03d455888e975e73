"""Cleaning, tags and settings, as Column expressions.

A label cascade is a list of (label, ways): the first label of which one way,
a list of words, is wholly in the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Cascade = list[tuple[str, list[list[str]]]]

# Labels and the words that give them, in order of precedence.
IDENTITIES: Cascade = [
    ("医学博士", [["医学博士"]]), ("理工科博士", [["理工科", "博士"]]), ("金融学博士", [["金融", "学博士"]]), ("美国博士在读", [["博士", "在读", "美国"]]), ("博士在读", [["博士", "在读"]]), ("博士", [["博士"]]),
    ("硕士离异", [["硕士", "离异"]]), ("硕士", [["硕士"]]), ("本科", [["本科"]]), ("VC工作", [["高端VC"], ["VC", "工作"], ["VC", "上班"]]), ("自媒体", [["自媒体"]]), ("国企职员", [["国企", "职员"], ["国企", "工作"]]),
    ("离异国企职员", [["离异", "国企"]]), ("离异", [["离异"]]), ("嫁二代", [["老公", "二代"]]), ("清纯类型", [["清纯类型"], ["清纯", "外机场"]]), ("香港金融", [["香港", "金融"]]),
    ("高中老师", [["高中", "老师"], ["高中", "教师"]]), ("YC工作", [["YC"], ["yc"], ["Yc"], ["yC"]]), ("短婚无娃", [["短婚", "无娃"]]),
]
OCCUPATIONS: Cascade = [
    ("学生", [["学生"]]), ("老师", [["老师"], ["教师"]]), ("医生", [["医生"]]), ("律师", [["律师"]]), ("公务员", [["公务员"]]), ("创业者", [["创业"]]), ("老板", [["老板"]]), ("销售", [["销售"]]),
    ("程序员", [["程序员"]]), ("工程师", [["工程师"]]), ("设计师", [["设计师"]]), ("模特", [["模特"]]), ("主播", [["主播"]]), ("全职妈妈", [["全职妈妈"]]),
    ("宝妈", [["宝妈"]]), ("护士", [["护士"]]), ("翻译", [["翻译"]]), ("空姐", [["空姐"]]), ("投行", [["投行"]]), ("咨询", [["咨询"]]), ("会计", [["会计"]]), ("金融", [["金融"]]), ("互联网", [["互联网"]]), ("大厂", [["大厂"]]),
]
TAG_DEGREES: Cascade = [("博士", [["博士"]]), ("硕士", [["硕士"]]), ("本科", [["本科"]])]
TAG_WORK: Cascade = [
    ("医生", [["医生"], ["医学"]]), ("律师", [["律师"]]), ("教师", [["教师"], ["老师"]]), ("程序员", [["程序员"], ["码农"]]), ("体制内", [["公务员"], ["体制内"]]), ("航空", [["航空"]]),
    ("单亲妈妈", [["单亲妈妈"]]), ("美国", [["美国"], ["美利国"]]), ("主播", [["主播"]]), ("艺术", [["表演"], ["播音"]]),
]
TOPICS: Cascade = [
    (topic, [[w] for w in words.split()]) for topic, words in (
        ("marriage", "结婚 婚姻 订婚 离婚 复婚 婚检 催婚 领证 围城"),
        ("relationship", "恋爱 男友 女友 对象 分手 复联 暧昧 追求 相亲 感情 关系 择偶"),
        ("career", "工作 职业 上班 晋升 转行 创业 事业 职场 岗位 老板 公司 offer 实习"),
        ("money", "钱 收入 存款 彩礼 房 车 资产 负债 礼物 花钱 米 工资 财务"),
        ("family", "父母 妈妈 爸爸 婆婆 公婆 家里 家庭 孩子 娃 原生家庭"),
        ("education", "本科 硕士 博士 读书 学校 留学 考研 高考 学历 老师"),
        ("health", "生病 抑郁 焦虑症 怀孕 流产 身体 健康 手术"),
        ("social", "朋友 社交 圈子 人脉 同学 同事"),
        ("emotion", "情绪 难受 崩溃 痛苦 内耗 不开心 焦虑 委屈"),
        ("self_growth", "成长 提升 自信 自卑 改变 规划 目标 人生"),
    )
]
GREETED_BY, PROMPTS = ("哈喽", "你好", "嗨", "喂", "hello", "hi"), ("你说", "你讲", "请讲", "说吧", "说说", "讲吧", "讲讲", "慢慢说", "听得到", "能听到", "在吗", "在线吗")
DROPPED = " \t\r\n,，。.!！？?、:：;；\"'“”‘’（）()-[]【】"
STAGES, PARTS = ("_final", "_formal", "_processed"), ("opening_", "comment_", "call_")
OPENINGS = (("开场白", "开场"), ("主播开场", "开场"), ("直播开场", "开场"))
TAG_EDUCATION, TAG_JOBS = "硕士|博士|本科|大学生|研究生|大专|高中", "程序员|工程师|医生|老师|学生|律师|会计|设计师|产品经理|销售|HR|运营|管理层"


def holds(text: Column, ways: list[list[str]]) -> Column:
    one = lambda words: reduce(Column.__and__, [F.contains(text, F.lit(w)) for w in words])
    return reduce(Column.__or__, [one(w) for w in ways])


def first_label(text: Column, cascade: Cascade, otherwise: str | None = None) -> Column:
    out = F.lit(otherwise)
    for label, ways in reversed(cascade):
        out = F.when(holds(text, ways), label).otherwise(out)
    return out


def every_label(text: Column, cascade: Cascade) -> Column:
    return F.array_compact(F.array(*[F.when(holds(text, ways), label) for label, ways in cascade]))


def topic(text: Column) -> Column:
    return first_label(text, TOPICS, "other")


def identity(text: Column, occupations: bool = False) -> Column:
    return first_label(text, IDENTITIES + (OCCUPATIONS if occupations else []))


def multi_tag(text: Column) -> Column:
    """Age and the first two labels, of degrees one; a general label without either."""
    years = F.nullif(F.regexp_extract(text, r"(\d{2})岁", 1), F.lit(""))
    labels = F.concat(F.slice(every_label(text, TAG_DEGREES), 1, 1), every_label(text, TAG_WORK))
    parts = F.array_compact(F.concat(F.array(F.concat(years, F.lit("岁"))), F.slice(labels, 1, 2)))
    return F.when(F.size(parts) > 0, F.array_join(parts, "")).otherwise("观众")


def validated_tag(text: Column, low: int = 20, high: int = 60) -> Column:
    """Age with education or work, or what there is of them; an age must be one's own, or else be within bounds."""
    some = lambda pattern, k=1: F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))
    within = lambda v: F.when(v.try_cast("int").between(low, high), v)
    said = [within(some(rf"{p}(\d{{2}})岁")) for p in ("我今年", "我", "我是")]
    any_age = F.get(F.filter(F.regexp_extract_all(text, F.lit(r"(\d{2})岁"), F.lit(1)), lambda v: v.cast("int").between(low, high)), F.lit(0))
    years = F.concat(F.coalesce(*said, any_age), F.lit("岁"))
    read = some("(读硕|读博|读研)")
    education = F.coalesce(some(f"({TAG_EDUCATION})"), F.when(read == "读硕", "硕士").when(read == "读博", "博士").otherwise(read))
    work = F.coalesce(some(f"我是.*?({TAG_JOBS})"), some(f"({TAG_JOBS})"), some("做.*?(开发|设计|销售|运营|管理)"), some("(国企|外企|私企|创业)"))
    return F.coalesce(F.concat(years, education), F.concat(years, work), years, education, work, some("(男生|女生)"), some("(单身|已婚|离异)"), F.lit("未知"))


def seconds_of(text: Column) -> Column:
    """Seconds of h:mm:ss, m:ss or a plain number, with fractions; 0 for anything else."""
    part = lambda pattern, k: F.regexp_extract(F.trim(text), pattern, k).try_cast("double")
    long, short = r"^(\d+):(\d{2}):(\d{2}(?:\.\d+)?)$", r"^(\d+):(\d{2}(?:\.\d+)?)$"
    return F.coalesce(part(long, 1) * 3600 + part(long, 2) * 60 + part(long, 3), part(short, 1) * 60 + part(short, 2), F.trim(text).try_cast("double"), F.lit(0.0))


def clean_title(text: Column) -> Column:
    """A file's name without marks of stages, parts and numbers."""
    out = F.trim(F.coalesce(text, F.lit("")))
    for mark in STAGES:
        out = F.replace(out, F.lit(mark), F.lit(""))
    out = F.regexp_replace(out, r"^\d+[_ -]*", "")
    for mark in PARTS:
        out = F.replace(out, F.lit(mark), F.lit(""))
    for a, b in OPENINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    out = F.regexp_replace(F.regexp_replace(out, "_(连麦|评论)$", ""), r"_000\d+_\d+.*$", "")
    return F.btrim(out, F.lit("_- "))


def memory_sentences(text: Column, most: int = 96) -> Column:
    """Sentences without their ends and with single spaces, each cut to ``most`` characters."""
    parts = F.transform(F.split(text, r"[。！？!?；;\n]"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " ")))
    return F.transform(F.filter(parts, lambda s: s != ""), lambda s: F.substring(s, 1, most))


def bare(text: Column) -> Column:
    """Lower case without white space and punctuation."""
    return F.translate(F.lower(text), DROPPED, "")


def opening_prompt(text: Column, short: int = 12) -> Column:
    """Whether a host asks a guest to begin: a prompt, with a greeting before it or in few characters."""
    b = bare(text)
    prompts = reduce(Column.__or__, [F.contains(b, F.lit(p)) for p in PROMPTS])
    greets = reduce(Column.__or__, [F.startswith(b, F.lit(p)) for p in GREETED_BY])
    return prompts & (greets | (F.length(b) <= short))


def issue_path(parts: Column) -> Column:
    """``$.a.b[0]`` of names and indexes; ``$`` of none."""
    joined = F.aggregate(parts, F.lit(""), lambda a, p: F.when(p.rlike(r"^\d+$"), F.concat(a, F.lit("["), p, F.lit("]"))).when(a == "", p).otherwise(F.concat(a, F.lit("."), p)))
    return F.when(F.size(parts) == 0, "$").otherwise(F.concat(F.lit("$."), joined))


def shown_time(utc: Column, zone: str = "Asia/Shanghai") -> Column:
    """A UTC time without zone as it is shown in ``zone``; a dash for none."""
    return F.coalesce(F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc), "yyyy年M月d日 HH:mm:ss"), F.lit("-"))


def shown_path(path: Column, most: int = 96) -> Column:
    long = F.concat(F.substring(path, 1, most - 16), F.lit("..."), F.right(path, F.lit(12)))
    return F.when(F.coalesce(path, F.lit("")) == "", "-").when(F.length(path) <= most, path).otherwise(long)


def noted(notes: Column, note: str) -> Column:
    """The notes with one more, once."""
    old = F.coalesce(notes, F.lit(""))
    return F.when(F.contains(old, F.lit(note)), old).when(old == "", F.lit(note)).otherwise(F.concat(old, F.lit("; "), F.lit(note)))


def positive_int(value: Column, otherwise: int) -> Column:
    n = F.floor(value.try_cast("double"))
    return F.when(n > 0, n).otherwise(otherwise).cast("long")


def clamped(value: Column, otherwise: float, low: float, high: float) -> Column:
    n = value.try_cast("double")
    return F.when(n.isNull() | F.isnan(n), otherwise).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), n)))


def label_mask(tokens: Column, spans: Column, most: int, none: int = -100) -> Column:
    """Labels of the last ``most`` tokens (start, end, id): the id where a token overlaps one of ``spans`` (start, end), else ``none``."""
    own = F.transform(tokens, lambda t: F.when(F.exists(spans, lambda s: (t["start"] < s["end"]) & (t["end"] > s["start"])), t["id"]).otherwise(none))
    return F.when(F.size(own) > most, F.slice(own, F.size(own) - most + 1, most)).otherwise(own)


def monologue(seconds: Column, rms_std: Column, zcr: Column) -> Column:
    """Even and calm speech; null for less than 3 s."""
    return F.when(seconds >= 3, (rms_std < 0.05) & (zcr < 0.08))
