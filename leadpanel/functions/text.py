"""Names, places and display text as native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# ---- fixed values: legal entity words (delivery style) --------------------------
ENTITY = (
    r"(?i)\b(LLC|L\.L\.C\.|INC|INC\.|CORP|CORPORATION|CO|CO\.|COMPANY|TRUST|TR|REVOCABLE|"
    r"IRREVOCABLE|LIVING|ESTATE|LP|L\.P\.|LLP|L\.L\.P\.|PLLC|P\.L\.L\.C\.|FOUNDATION|"
    r"ASSOCIATION|PARTNERSHIP|HOLDINGS?|ET\s+AL)\b"
)
KEEP_UPPER = ["LLC", "INC", "CORP", "TRUST", "LP", "LLP", "PLLC"]

# ---- fixed values: words that mark a non-person (structured style) --------------
NOT_PERSON = (
    r"\b(LLC|INC|CORP|TRUST|LTD|COMPANY|ASSOC|FOUNDATION|ESTATE|REVOCABLE|IRREVOCABLE|LIVING|"
    r"PARTNERSHIP|VENTURE|HOA)\b"
)

# ---- fixed values: subdivision words that carry no name (compared in upper case) -
SUBDIVISION_NOISE = [
    "PARCEL", "ADDITION", "PUD", "OT", "&", "LG", "FLG", "FILING", "PHASE", "PATIO HOMES", "PATIO",
    "PH", "SUB", "-", "REP", "(REPLAT)", "REPLAT", "REPLAT OF", "II", "III",
    "1ST", "2ND", "3RD", "4TH", "5TH", "6TH", "7TH", "8TH", "9TH", "10TH",
    "0", "1", "2", "3", "4", "5", "6", "7", "8", "9", "10", "11", "12", "13", "14", "15", "16", "17", "18", "19", "20",
    "A", "B", "C", "D", "E", "F", "G", "H", "I", "J", "K",
]


def blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def tokens(text: Column) -> Column:
    """Words of a text split on any white space; empty for a blank text."""
    return F.filter(F.split(F.trim(text), r"\s+"), lambda w: w != "")


def capital(word: Column) -> Column:
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substring(word, 2, 10_000_000)))


def name_word(word: Column) -> Column:
    """Company suffixes stay in upper case, everything else is capitalised."""
    bare = F.btrim(F.upper(word), F.lit("."))
    return F.when(bare.isin(KEEP_UPPER), bare).otherwise(capital(word))


def _rest(words: Column, start: int) -> Column:
    return F.slice(words, F.lit(start), F.greatest(F.size(words) - (start - 1), F.lit(0)))


def _last_first(last: Column, others: Column) -> Column:
    return F.when(F.size(others) > 0, F.concat(last, F.lit(", "), F.array_join(others, " "))).otherwise(last)


def owner_pair(owner: Column) -> Column:
    """struct(owner_1, owner_2): "LAST FIRST & FIRST2" as "Last, First" twice; entities stay as they are."""
    text = F.trim(owner)
    at = F.instr(text, " & ")
    first = F.when(at > 0, F.trim(F.substring(text, F.lit(1), at - 1))).otherwise(text)
    second = F.when(at > 0, F.trim(F.substring(text, at + 3, F.length(text))))
    one, two = tokens(first), tokens(second)
    owner_1 = _last_first(name_word(F.get(one, F.lit(0))), F.transform(_rest(one, 2), name_word))
    last_word = F.btrim(F.try_element_at(two, F.lit(-1)), F.lit("."))
    # One word, or a closing initial, means the second owner shares the first one's last name.
    own_last = (F.size(two) > 1) & (F.length(last_word) != 1)
    full = F.when(own_last, two).otherwise(F.concat(two, F.array(F.get(one, F.lit(0)))))
    owner_2 = _last_first(
        name_word(F.try_element_at(full, F.lit(-1))), F.transform(F.slice(full, F.lit(1), F.size(full) - 1), name_word)
    )
    entity = text.rlike(ENTITY)
    return F.struct(
        F.when(blank(owner), F.lit(None)).when(entity, text).when(F.size(one) > 0, owner_1).alias("owner_1"),
        F.when(blank(owner) | entity, F.lit(None)).when(F.size(two) > 0, owner_2).alias("owner_2"),
    )


def _title(text: Column) -> Column:
    """Capital after every non-letter, as in a title."""
    return F.trim(F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"([A-Za-z]+|[^A-Za-z]+)")), capital), ""))


def _person(first: Column, middle: Column, last: Column) -> Column:
    def part(c: Column) -> Column:
        return F.coalesce(_title(c), F.lit(""))

    return F.struct(part(first).alias("first"), part(middle).alias("middle"), part(last).alias("last"))


def owner_people(owner: Column) -> Column:
    """array<struct(first, middle, last)> of the people named; empty for entities and blank text."""
    raw = F.upper(F.regexp_replace(F.trim(owner), r"\s+", " "))
    parts = F.split(raw, r" & | AND ")
    head = F.get(parts, F.lit(0))
    has_comma = F.contains(head, F.lit(","))
    comma = F.instr(head, ",")
    before, after = F.trim(F.substring(head, F.lit(1), comma - 1)), tokens(F.substring(head, comma + 1, F.length(head)))
    plain = tokens(head)
    last = F.when(has_comma, before).otherwise(F.get(plain, F.lit(0)))
    middle = lambda w: F.array_join(w, " ")
    main = (
        F.when(has_comma, _person(F.get(after, F.lit(0)), middle(_rest(after, 2)), before))
        .when(F.size(plain) > 1, _person(F.get(plain, F.lit(1)), middle(_rest(plain, 3)), last))
        .otherwise(_person(F.lit(""), F.lit(""), last))
    )

    def other(text: Column) -> Column:
        words = tokens(text)
        cut = F.instr(text, ",")
        given = tokens(F.substring(text, cut + 1, F.length(text)))
        first, final = F.get(words, F.lit(0)), F.try_element_at(words, F.lit(-1))
        inner = F.slice(words, F.lit(2), F.greatest(F.size(words) - 2, F.lit(0)))
        shared = _person(first, F.lit(""), last)
        initial = (F.length(final) <= 2) | final.endswith(".")
        with_comma = (
            F.when(F.size(words) == 1, shared)
            .when(cut > 0, _person(F.get(given, F.lit(0)), middle(_rest(given, 2)), F.trim(F.substring(text, F.lit(1), cut - 1))))
            .otherwise(_person(first, middle(inner), final))
        )
        without_comma = (
            F.when(F.size(words) == 1, shared)
            .when((F.size(words) == 2) & initial, _person(first, final, last))
            .when(F.size(words) == 2, _person(first, F.lit(""), final))
            .when(final == last, _person(first, middle(inner), last))
            .otherwise(_person(first, middle(_rest(words, 2)), last))
        )
        return F.when(has_comma, with_comma).otherwise(without_comma)

    more = F.filter(F.transform(_rest(parts, 2), lambda p: F.trim(p)), lambda p: p != "")
    # A joint owner after a lone last name is not read.
    lone = ~has_comma & (F.size(plain) < 2)
    people = F.when(lone, F.array(main)).otherwise(F.concat(F.array(main), F.transform(more, other)))
    skip = blank(owner) | raw.rlike(NOT_PERSON) | (~has_comma & (F.size(plain) == 0))
    nobody = F.filter(F.array(_person(F.lit(""), F.lit(""), F.lit(""))), lambda p: p["last"] != "")
    return F.when(~skip, people).otherwise(nobody)


def subdivision_name(text: Column) -> Column:
    """First three words without filing noise, capitalised; a closing "Of" is dropped."""
    words = F.slice(tokens(text), 1, 3)
    kept = F.transform(F.filter(words, lambda w: ~F.upper(w).isin(SUBDIVISION_NOISE)), capital)
    kept = F.when(F.try_element_at(kept, F.lit(-1)) == "Of", F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)
    return F.when(text.isNotNull(), F.array_join(kept, " "))


def parcel_id(value: Column, numeric: bool) -> Column:
    """Numbers become integer text, texts are trimmed; null and "0" become null."""
    text = value.cast("double").cast("bigint").cast("string") if numeric else F.trim(value)
    return F.when(text != "0", text)


def whole_text(value: Column) -> Column:
    """Number as integer text, null kept."""
    return value.cast("double").cast("bigint").cast("string")


def no_nan(text: Column) -> Column:
    return F.when(~text.isin("nan", "NAN"), text)


def zip_text(value: Column) -> Column:
    return no_nan(F.regexp_replace(value.cast("string"), r"\.0$", ""))


def trailing_digits(text: Column) -> Column:
    digits = F.regexp_extract(text.cast("string"), r"(\d+)$", 1)
    return F.when(digits != "", digits)


def home_index(county: Column, state: Column, number: Column) -> Column:
    return F.concat_ws("_", F.upper(F.trim(county)), state, number.cast("string"))


def index_from_file(name: Column) -> Column:
    """Home number from an image name: <n>_original_index, ..._<n>, or the first digits anywhere."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    marked = F.regexp_extract(stem, r"^_*(\d+)_*_original_index$", 1)
    last = F.regexp_extract(stem, r"(?:^|_)([+-]?\d+)$", 1)
    any_digits = F.regexp_extract(name, r"(\d+)", 1)
    found = F.coalesce(*[F.when(c != "", c) for c in (marked, last, any_digits)])
    return found.try_cast("bigint")


def address_text(*parts: Column) -> Column:
    return F.concat_ws(", ", *[F.trim(F.coalesce(p.cast("string"), F.lit(""))) for p in parts])


def personal_first(addresses: Column, personal: Column) -> Column:
    """E-mail addresses with the personal ones first, order kept within each kind."""
    return F.concat(
        F.filter(addresses, lambda a: F.array_contains(personal, a)),
        F.filter(addresses, lambda a: ~F.array_contains(personal, a)),
    )


# ---- display text ------------------------------------------------------------------
DASH = "—"


def or_dash(text: Column) -> Column:
    return F.when(~blank(text), text).otherwise(F.lit(DASH))


def comma_number(text: Column) -> Column:
    """Number text with thousands commas; text that is no number stays, blank becomes a dash."""
    number = F.regexp_replace(text, ",", "").try_cast("double")
    return F.when(blank(text), F.lit(DASH)).when(number.isNull(), text).otherwise(F.format_number(number, 0))


def money(text: Column) -> Column:
    shown = comma_number(text)
    return F.when(shown == DASH, shown).otherwise(F.concat(F.lit("$"), shown))


def us_date(text: Column, parsed: Column) -> Column:
    return F.when(blank(text), F.lit(DASH)).when(parsed.isNull(), F.trim(text)).otherwise(
        F.date_format(parsed, "MM/dd/yyyy")
    )


def owners_line(one: Column, two: Column, missing: str = DASH) -> Column:
    return F.when(blank(one), F.lit(missing)).when(blank(two), one).otherwise(F.concat_ws(" & ", one, two))


def place_line(city: Column, state: Column, zip_code: Column, index: Column) -> Column:
    place = F.concat_ws(", ", F.upper(city), F.upper(state))
    zip_whole = F.floor(zip_code.try_cast("double")).cast("string")
    with_zip = F.when(zip_whole.isNotNull(), F.concat_ws(" ", place, zip_whole)).otherwise(place)
    return F.when(city.isNotNull() & state.isNotNull(), with_zip).otherwise(
        F.concat(F.lit("ID: "), index.cast("string"))
    )


def score_text(has_target: Column, score: Column) -> Column:
    return F.when(F.coalesce(has_target, F.lit(False)), F.lit("N/A")).otherwise(
        F.coalesce(score.cast("string"), F.lit(DASH))
    )


def point_label(address: Column, city: Column, index: Column) -> Column:
    joined = F.concat_ws(", ", *[F.when(~blank(c), F.trim(c)) for c in (address, city)])
    return F.coalesce(F.nullif(joined, F.lit("")), index)
