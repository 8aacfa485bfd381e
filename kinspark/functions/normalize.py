"""Normalized views of names and addresses as Column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kinspark.functions.phonetic import metaphone

# Words of legal forms, abbreviations, landmark words and state codes.
LEGAL = (
    "inc", "incorporated", "corp", "corporation", "co", "company", "llc", "l.l.c", "ltd",
    "limited", "pvt", "private", "llp", "plc", "gmbh", "sa", "sas", "sarl", "bv", "nv", "ag",
    "pte", "opc", "huf", "and", "&", "the", "dba", "trading", "enterprises", "enterprise",
)
NAME_ABBREVIATIONS = {
    "intl": "international", "tech": "technology", "svcs": "services", "svc": "service",
    "mgmt": "management", "assoc": "associates", "bros": "brothers", "mfg": "manufacturing",
    "univ": "university", "natl": "national", "grp": "group", "hldgs": "holdings",
}
ADDRESS_ABBREVIATIONS = {
    "rd": "road", "st": "street", "ave": "avenue", "blvd": "boulevard", "dr": "drive",
    "ln": "lane", "hwy": "highway", "n": "north", "s": "south", "e": "east", "w": "west",
    "nr": "near", "opp": "opposite", "apt": "apartment", "fl": "floor", "bldg": "building",
    "sec": "sector", "extn": "extension", "indl": "industrial",
}
LANDMARKS = ("near", "nr", "opposite", "opp", "behind", "next", "beside", "adjacent")
STATES = (
    "al", "ak", "az", "ar", "ca", "co", "ct", "de", "fl", "ga", "hi", "id", "il", "in", "ia",
    "ks", "ky", "la", "me", "md", "ma", "mi", "mn", "ms", "mo", "mt", "ne", "nv", "nh", "nj",
    "nm", "ny", "nc", "nd", "oh", "ok", "or", "pa", "ri", "sc", "sd", "tn", "tx", "ut", "vt",
    "va", "wa", "wv", "wi", "wy", "dc",
)

NAME_VIEWS = ("name_raw", "name_full", "name_no_legal", "name_sorted", "name_compact", "name_init")
ADDRESS_VIEWS = ("addr_raw", "addr_full", "addr_no_digits", "addr_sorted", "pincode", "zip5", "house_no", "is_landmark", "city", "state")


def _strings(words) -> Column:
    return F.array(*(F.lit(w) for w in words))


def base(text: Column) -> Column:
    """Lower case, ``&`` as a word, everything but letters, numbers and ``_`` to single spaces. Expects NFKC text."""
    return F.trim(F.regexp_replace(F.replace(F.lower(text), F.lit("&"), F.lit(" and ")), r"[^\p{L}\p{N}_]+", " "))


def tokens(text: Column, abbreviations: dict[str, str]) -> Column:
    """Words with abbreviations expanded."""
    table = F.create_map(*(F.lit(x) for pair in abbreviations.items() for x in pair))
    words = F.filter(F.split(base(text), " "), lambda t: t != "")
    return F.transform(words, lambda t: F.coalesce(F.try_element_at(table, t), t))


def _first(values: Column) -> Column:
    return F.coalesce(F.try_element_at(values, F.lit(1)), F.lit(""))


def name_words(text: Column) -> Column:
    """N2 of a name."""
    return tokens(text, NAME_ABBREVIATIONS)


def without_legal(words: Column) -> Column:
    """N3, after abbreviations are expanded."""
    return F.filter(words, lambda t: ~F.array_contains(_strings(LEGAL), t))


def name_views(text: Column, full: Column | None = None, clean: Column | None = None) -> dict[str, Column]:
    """N4-N9, from the words of the name with and without legal ones, where the caller has them as columns already."""
    full = name_words(text) if full is None else full
    clean = without_legal(full) if clean is None else clean
    return {
        "name_raw": base(text),
        "name_full": F.array_join(full, " "),
        "name_no_legal": F.array_join(clean, " "),
        "name_sorted": F.array_join(F.array_sort(clean), " "),
        "name_compact": F.array_join(clean, ""),
        "name_init": F.array_join(F.transform(clean, lambda t: F.substring(t, 1, 1)), ""),
    }


def address_words(text: Column) -> Column:
    return tokens(text, ADDRESS_ABBREVIATIONS)


def digit_runs(text: Column) -> dict[str, Column]:
    """Digit runs come from the text as given, so a postal code can be the house number."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{Nd}+)"), F.lit(1))
    sized = lambda n: _first(F.filter(runs, lambda d: F.length(d) == n))
    return {"pincode": sized(6), "zip5": sized(5), "house_no": _first(runs)}


def address_views(text: Column, given: Column | None = None, full: Column | None = None) -> dict[str, Column]:
    """N11-N21; ``given`` is the address before NFKC, ``full`` its words where the caller has them as a column already."""
    full = address_words(text) if full is None else full
    plain = F.filter(full, lambda t: ~t.rlike(r"^\p{Nd}+$"))
    state = _first(F.filter(full, lambda t: F.array_contains(_strings(STATES), t)))
    before = F.array_position(plain, state)
    city = F.when(before > 1, F.try_element_at(plain, (before - 1).cast("int")))
    digits = digit_runs(text if given is None else given)
    return {
        "addr_raw": base(text),
        "addr_full": F.array_join(full, " "),
        "addr_no_digits": F.array_join(plain, " "),
        "addr_sorted": F.array_join(F.array_sort(plain), " "),
        **digits,
        "is_landmark": F.arrays_overlap(full, _strings(LANDMARKS)).cast("int"),
        "city": F.coalesce(city, F.lit("")),
        "state": state,
    }


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """N1a; Spark has no built-in for it."""
    return text.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


@F.pandas_udf(StringType())
def metaphone_code(text: pd.Series) -> pd.Series:
    return text.map(lambda s: metaphone(s) if s else "")


def with_nfkc(df: DataFrame, columns: list[str]) -> DataFrame:
    """NFKC of some columns. Rows that are ASCII in all of them, where it changes nothing, never reach Python; no shuffle."""
    odd = F.lit(False)
    for c in columns:
        odd = odd | F.col(c).rlike(r"[^\x00-\x7F]")
    return df.where(~odd).unionByName(df.where(odd).withColumns({c: nfkc(c) for c in columns}))


def normalize(df: DataFrame, phonetic: str = "initials", unicode_forms: bool = True) -> DataFrame:
    """The four input columns and 17 views.

    ``phonetic``: "metaphone" codes the name without legal words (N10); "initials" is the fallback without a phonetic coder.
    ``unicode_forms`` applies NFKC (N1a) first to the name and address used for the views; the input columns stay as given, and
    digit runs are those of the address as given. Nulls count as empty strings."""
    df = df.na.fill("", ["entity_id", "business_name", "business_address", "country"])
    given = df.withColumns({"_name": F.col("business_name"), "_address": F.col("business_address")})
    if unicode_forms:
        given = with_nfkc(given, ["_name", "_address"])
    # Words are columns of their own, so that no view splits the text again.
    given = given.withColumns({"_full": name_words(F.col("_name")), "_words": address_words(F.col("_address"))})
    given = given.withColumn("_clean", without_legal(F.col("_full")))
    views = name_views(F.col("_name"), F.col("_full"), F.col("_clean")) | address_views(F.col("_address"), F.col("business_address"), F.col("_words"))
    out = given.withColumns(views).drop("_name", "_address", "_full", "_words", "_clean")
    if phonetic == "metaphone":
        names = out.select("name_no_legal").distinct().withColumn("name_meta", metaphone_code("name_no_legal"))
        return out.join(names, "name_no_legal").select(*df.columns, *NAME_VIEWS, *ADDRESS_VIEWS, "name_meta")
    return out.withColumn("name_meta", F.col("name_init"))
