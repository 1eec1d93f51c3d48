"""Text functions over columns.

Everything runs in the JVM. Compatibility forms and case folding are those of ICU, which Spark brings along; texts of ASCII
characters alone skip them. Spark holds such calls for not deterministic, so they stand in projections and filters, not in aggregates.
"""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column, types
from pyspark.sql import functions as F

from tagloom.functions import fixed

CJK = r"\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}"


def _icu(kind: str, method: str, c: Column) -> Column:
    return F.reflect(F.lit(f"com.ibm.icu.{kind}"), F.lit(method), F.coalesce(c, F.lit("")), F.lit(True))


def nfkc(c: Column) -> Column:
    """Compatibility composition (NFKC)."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), _icu("text.Normalizer", "compose", c)).otherwise(c)


def casefold(c: Column) -> Column:
    """Full case folding."""
    return F.when(c.rlike(r"[^\x00-\x7F]"), _icu("lang.UCharacter", "foldCase", c)).otherwise(F.lower(c))


def words_pattern(words: list[str]) -> str:
    return "|".join(f"\\Q{w}\\E" for w in words)


def bind(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def blank(c: Column) -> Column:
    return c.isNull() | F.trim(c.cast("string")).isin("", "nan", "None", "<NA>")


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def clean_raw(c: Column) -> Column:
    text = F.when(blank(c), F.lit("")).otherwise(F.trim(nfkc(c.cast("string"))))
    return squeeze(functools.reduce(lambda t, w: F.replace(t, F.lit(w), F.lit(" ")), fixed.NOISE_WORDS, text))


def normalize(c: Column) -> Column:
    text = F.lower(nfkc(F.when(blank(c), F.lit("")).otherwise(c.cast("string"))))
    return F.regexp_replace(F.regexp_replace(text, "[’'`]", ""), rf"[^\p{{L}}\p{{N}}{CJK}]", "")


def surface_key(c: Column) -> Column:
    return F.regexp_replace(casefold(clean_raw(c)), r"(?U)\s+", "")


def latin_part(normal: Column) -> Column:
    return F.regexp_replace(normal, "[^a-z0-9]", "")


def cjk_part(normal: Column) -> Column:
    return F.regexp_replace(normal, f"[^{CJK}]", "")


def latin_tokens(c: Column) -> Column:
    text = F.regexp_replace(F.lower(nfkc(F.coalesce(c.cast("string"), F.lit("")))), "[’']", "")
    keep = lambda t: (F.length(t) >= 4) & ~t.isin(fixed.STOP_TOKENS)
    return F.array_distinct(F.filter(F.regexp_extract_all(text, F.lit("[a-z0-9]+"), F.lit(0)), keep))


def is_bilingual(c: Column) -> Column:
    latin_first = rf"^[^\x{{3400}}-\x{{9FFF}}]*[A-Za-z0-9][^\x{{3400}}-\x{{9FFF}}]*(?U:\s)+[\x{{3400}}-\x{{9FFF}}].*$"
    cjk_first = r"^[\x{3400}-\x{9FFF}][^A-Za-z]*(?U:\s)+[A-Za-z].*$"
    return c.rlike(latin_first) | c.rlike(cjk_first)


def extract_bracket(title: Column) -> Column:
    text = F.when(blank(title), F.lit("")).otherwise(title.cast("string"))
    found = F.regexp_extract_all(text, F.lit(r"【[^】]*】|\[[^\]]*\]"), F.lit(0))
    inner = F.filter(F.transform(found, lambda x: clean_raw(F.substring(x, F.lit(2), F.length(x) - 2))), lambda x: x != "")
    first = F.coalesce(F.get(inner, F.lit(0)), F.lit(""))
    for p in fixed.ORIGIN_PREFIXES:
        first = bind(first, _strip_prefix(p))
    return F.trim(first)


def _strip_prefix(p: str):
    return lambda b: F.when(F.startswith(b, F.lit(p)) & (F.length(b) > len(p)), F.substring(b, len(p) + 1, 1 << 20)).otherwise(b)


def is_generic(b: Column) -> Column:
    return b.isNull() | (b == "") | b.rlike(words_pattern(fixed.GENERIC_WORDS)) | (F.length(normalize(b)) > 14)


def long_enough(a: Column) -> Column:
    cjk = F.length(cjk_part(a))
    return ((cjk == 0) & (F.length(a) >= 5)) | (cjk >= 3)


def id_str(c: Column) -> Column:
    return F.when(blank(c), F.lit("")).otherwise(c.cast("double").cast("long").cast("string"))


def host_brand(c: Column) -> Column:
    return bind(normalize(c), lambda n: n.isin(fixed.HOST_NAMES) | n.rlike(f"^(?:{fixed.HOST_FAMILY})$"))


def compatible(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike("(?iu)" + fixed.COMPATIBLE.replace(r"\s", r"(?U:\s)"))


def accessory(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike("(?iu)" + fixed.ACCESSORY)


def why_not_brand(c: Column) -> Column:
    """null if the string looks like a brand, else the reason why not."""

    def tests(raw: Column) -> Column:
        n = normalize(raw)
        category = F.get(F.filter(F.array(*map(F.lit, fixed.CATEGORY_WORDS)), lambda w: F.contains(raw, w)), F.lit(0))
        return (
            F.when(raw == "", "空白")
            .when(n == "", "沒有可辨識的文字")
            .when(n.isin(fixed.NOT_BRAND_WORDS) | F.lower(raw).isin(fixed.NOT_BRAND_WORDS), "通用詞，非特定品牌")
            .when(raw.rlike(fixed.PROMOTION), "促銷或販售描述，非品牌證據")
            .when(n.rlike(r"^\p{Nd}+$"), "純數字")
            .when(category.isNotNull(), F.concat(F.lit("含品類詞「"), category, F.lit("」，屬商品描述")))
            .when(raw.rlike(fixed.SPECIFICATION), "含規格或數量，屬商品描述")
            .when((F.length(cjk_part(n)) == 0) & (F.length(n) <= 1), "過短")
            .when(F.length(n) > 25, "過長，不像品牌名")
        )

    return bind(clean_raw(c), tests)


def looks_like_brand(c: Column) -> Column:
    return why_not_brand(c).isNull()


def brand_key(raw_brand: Column, title: Column, item_id: Column) -> Column:
    """The unit of decision: B: brand text, T: bracket text, I: single item."""
    single = F.concat(F.lit("I:"), item_id.cast("string"))

    def choose(bracket: Column) -> Column:
        name = normalize(clean_raw(raw_brand))
        # A brand of white space counts as given here, though it normalises to nothing.
        host = host_brand(F.when(F.coalesce(raw_brand, F.lit("")) != "", raw_brand).otherwise(bracket))
        return (
            F.when(host & accessory(title), single)
            .when(name != "", F.concat(F.lit("B:"), name))
            .when((bracket != "") & looks_like_brand(bracket) & ~is_generic(bracket), F.concat(F.lit("T:"), normalize(bracket)))
            .otherwise(single)
        )

    return bind(extract_bracket(title), choose)


def band(c: Column) -> Column:
    out = F.lit(fixed.BANDS[-1][1])
    for low, label in reversed(fixed.BANDS):
        out = F.when(c >= low, label).otherwise(out)
    return out


def half_even(c: Column) -> Column:
    return F.bround(c.cast("double"), 0)


def clamp_confidence(c: Column) -> Column:
    return F.least(F.greatest(half_even(c), F.lit(0.0)), F.lit(100.0)).cast("int")


def fingerprint(*fields: Column) -> Column:
    """Sixteen hex digits over the fields; null, empty and 0 are the same."""
    text = [F.coalesce(F.when(f.cast("string") != "0", f.cast("string")), F.lit("")) if k == 3 else F.coalesce(f.cast("string"), F.lit("")) for k, f in enumerate(fields)]
    return F.substring(F.sha1(F.concat_ws("|", *text).cast("binary")), 1, 16)


def language(c: Column) -> Column:
    n = normalize(c)
    cjk, latin = cjk_part(n) != "", latin_part(n) != ""
    return F.when(cjk & latin, fixed.LANG_BOTH).when(cjk, fixed.LANG_CJK).otherwise(fixed.LANG_LATIN)


def distinctive(fragment: Column) -> Column:
    cjk = F.length(cjk_part(fragment))
    return F.when(cjk > 0, cjk >= 4).otherwise(F.length(fragment) >= 6)


def safe_name(c: Column) -> Column:
    name = F.trim(F.regexp_replace(c, r'[\\/:*?"<>|]+', "_"))
    return F.when(name == "", "L1").otherwise(name)


def path_code(c: Column) -> Column:
    return F.get(F.split(F.coalesce(c, F.lit("")), " "), F.lit(0))


def label(name: Column, brand_id: Column) -> Column:
    return F.concat(F.coalesce(name, F.lit("?")), F.lit(" ["), brand_id.cast("string"), F.lit("]"))


def legacy_type(c: Column) -> Column:
    out = c
    for old, new in fixed.LEGACY_TYPES.items():
        out = F.when(c == old, new).otherwise(out)
    return out


def outcome_type(suggested: Column) -> Column:
    return F.when(suggested.isin(fixed.NONE, fixed.NEW), suggested).otherwise(fixed.POOL)


@F.pandas_udf(types.DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 * 2 * LCS / (len a + len b): the normalised insert/delete similarity.

    Arrow batches; the longest common subsequence goes bit-parallel over Python integers, a step for each character of b.
    """

    def one(x: str, y: str) -> float:
        if not x and not y:
            return 100.0
        masks: dict[str, int] = {}
        for i, ch in enumerate(x):
            masks[ch] = masks.get(ch, 0) | 1 << i
        full = (1 << len(x)) - 1
        s = full
        for ch in y:
            u = s & masks.get(ch, 0)
            s = (s + u | s - u) & full
        return 200.0 * (len(x) - s.bit_count()) / (len(x) + len(y))

    return pd.Series([one(x or "", y or "") for x, y in zip(a, b, strict=True)], dtype="float64")
