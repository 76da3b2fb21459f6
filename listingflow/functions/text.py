"""Free text to typed values: prices, sizes, types, addresses, keys, media paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import whole
from .patterns import all_groups, bind, collapsed, first_group, java, matches, replace_all, trimmed

# ---- Fixed values: must equal the listing rules for right results -------------------------
MIN_RENT_PW, MAX_RENT_PW = 100, 5000
OTHER_PERIOD = r"\b(per month|pcm|per annum|p\.?a\.?)\b"
WEEKLY_WORD = r"week|pw|p\/w"
MONEY = r"\$\s*([\d,]+(?:\.\d+)?)"

MIN_AREA_SQM, MAX_AREA_SQM = 15, 600
FIRST_NUMBER = r"([\d,]+(?:\.\d+)?)"

PROPERTY_TYPES = [
    (r"\bterrace\b", "terrace"),
    (r"\bduplex\b", "duplex"),
    (r"\btown\s?house\b", "townhouse"),
    (r"\bvilla\b", "townhouse"),
    (r"\bstudio\b", "other"),
    (r"\b(apartment|penthouse)\b", "apartment"),
    (r"\b(unit|flat)\b", "unit"),
    (r"\b(house|semi[-\s]?detached|cottage)\b", "house"),
]

ADDRESS_TAIL = r",\s*([^,]+?),?\s+([A-Z]{2,3})\s+(\d{4})\s*$"
POSTCODE = r"^\d{4}$"

STREET_TYPES = {
    "st": "Street", "str": "Street", "rd": "Road", "ave": "Avenue", "av": "Avenue",
    "pde": "Parade", "cres": "Crescent", "cr": "Crescent", "dr": "Drive", "drv": "Drive",
    "ct": "Court", "pl": "Place", "ln": "Lane", "hwy": "Highway", "tce": "Terrace",
    "cct": "Circuit", "esp": "Esplanade", "gr": "Grove", "sq": "Square", "wy": "Way",
    "bvd": "Boulevard", "blvd": "Boulevard",
}

LEADING_PROSE = r"^[^,\d]*?(?=\d+\s*\/)"
UNIT_PREFIX = r"^\s*[^,/]*\/\s*"
LEADING_DESCRIPTOR = r"^(studio|penthouse|apartment|unit|suite|level\s*\d*)\s+(?=\d)"
LAST_WORD = r"^(.*?)\s+([A-Za-z]+)\.?\s*$"

IMAGE_SIZE_SEGMENT = r"\/\d{2,4}x\d{2,4}\/"
IMAGE_SIZE = "1600x1200"
MEDIA_KEY = r"(?:^|\/)listings\/([^/]+)\/[^/]+$"
SNIPPET_LENGTH = 500
# -------------------------------------------------------------------------------------------


def _amount(text: Column) -> Column:
    return F.regexp_replace(text, ",", "").try_cast("double")


def weekly_rent(display: Column) -> Column:
    """Lowest plausible weekly dollar figure; monthly and annual prices are declined."""
    other_period = matches(display, OTHER_PERIOD, True) & ~matches(display, WEEKLY_WORD, True)
    amounts = F.filter(
        F.transform(all_groups(display, MONEY, 1), _amount),
        lambda v: v.between(MIN_RENT_PW, MAX_RENT_PW),
    )
    return F.when(~other_period, whole(F.array_min(amounts)))


def area_sqm(size: Column) -> Column:
    value = _amount(first_group(size, FIRST_NUMBER))
    return F.when(value.between(MIN_AREA_SQM, MAX_AREA_SQM), whole(value))


def first_matching(text: Column, rules: list[tuple[str, str]], default: str) -> Column:
    chain = F.when(text.isNull(), F.lit(default))
    for pattern, label in rules:
        chain = chain.when(matches(text, pattern, True), F.lit(label))
    return chain.otherwise(F.lit(default))


def property_type(display: Column) -> Column:
    return first_matching(display, PROPERTY_TYPES, "other")


def address_tail(address: Column) -> dict[str, Column]:
    """Suburb, state and postcode written at the end of a full address."""
    text = trimmed(address)
    suburb = first_group(text, ADDRESS_TAIL, 1)
    return {
        "suburb": trimmed(suburb),
        "state": first_group(text, ADDRESS_TAIL, 2),
        "postcode": first_group(text, ADDRESS_TAIL, 3),
    }


def slug(text: Column, joiner: str) -> Column:
    dashed = F.regexp_replace(F.lower(trimmed(text)), "[^a-z0-9]+", joiner)
    return F.regexp_replace(dashed, f"^{joiner}+|{joiner}+$", "")


def suburb_key(suburb: Column, postcode: Column) -> Column:
    return F.concat(slug(suburb, "-"), F.lit("-"), postcode)


def feature_key(feature: Column) -> Column:
    return slug(feature, "_")


def feature_list(features: Column) -> Column:
    """Normalised, without blanks, first occurrence kept."""
    return F.array_distinct(F.filter(F.transform(features, feature_key), lambda f: f != ""))


def snippet(description: Column, limit: int = SNIPPET_LENGTH) -> Column:
    """White space collapsed, cut on a word boundary when one lies past 60 % of the limit."""

    def on_word(cut: Column) -> Column:
        from_end = F.locate(" ", F.reverse(cut))  # 1-based, 0 when there is no space
        kept = F.length(cut) - from_end
        return F.when((from_end > 0) & (kept > limit * 0.6), F.left(cut, kept)).otherwise(cut)

    def shortened(clean: Column) -> Column:
        cut = bind(F.substring(clean, 1, limit - 1), on_word)
        return F.when(F.length(clean) <= limit, clean).otherwise(
            F.concat(replace_all(cut, r"\s+$", ""), F.lit("…"))
        )

    return bind(trimmed(collapsed(description)), shortened)


def price_display(display: Column, price_pw: Column) -> Column:
    shown = trimmed(display)
    return F.coalesce(
        F.when(shown != "", shown),
        F.concat(F.lit("$"), price_pw.cast("string"), F.lit(" per week")),
        F.lit("Contact agent"),
    )


def sized_image_url(url: Column, size: str = IMAGE_SIZE) -> Column:
    """Fill the first size placeholder, or rewrite the first ``/WxH/`` segment."""
    holder = F.locate("{size}", url)
    filled = F.concat(F.left(url, holder - 1), F.lit(size), F.substring(url, holder + 6, F.length(url)))
    segment = F.regexp_extract(url, IMAGE_SIZE_SEGMENT, 0)
    at = F.instr(url, segment)
    resized = F.concat(
        F.left(url, at - 1), F.lit(f"/{size}/"), F.substring(url, at + F.length(segment), F.length(url))
    )
    return F.when(holder > 0, filled).when(segment != "", resized).otherwise(url)


def building_address(address: Column) -> Column:
    """The street address of the building: no prose, no unit prefix, no leading descriptor."""
    text = replace_all(trimmed(address), LEADING_PROSE, "")
    text = replace_all(text, UNIT_PREFIX, "")
    return trimmed(replace_all(text, LEADING_DESCRIPTOR, "", True))


def expand_street_type(address: Column) -> Column:
    """Spell out an abbreviated street type that ends the first comma part."""
    parts = F.split(address, ",", -1)
    street = F.element_at(parts, 1)
    word = F.lower(first_group(street, LAST_WORD, 2))
    types = F.create_map(*[F.lit(x) for pair in STREET_TYPES.items() for x in pair])
    full = F.try_element_at(types, word)
    expanded = F.concat(first_group(street, LAST_WORD, 1), F.lit(" "), full)
    rest = F.slice(parts, F.lit(2), F.size(parts))
    return F.array_join(F.concat(F.array(F.coalesce(expanded, street)), rest), ",")


def plain_words(text: Column) -> Column:
    lowered = F.regexp_replace(F.lower(text), "[^a-z0-9 ]", " ")
    return F.trim(F.regexp_replace(lowered, " +", " "))


def street_of(address: Column) -> Column:
    street = F.element_at(F.split(expand_street_type(address), ",", -1), 1)
    return plain_words(replace_all(street, r"^\s*[\d-]+[a-z]?\s+", "", True))


def postcode_of(address: Column) -> Column:
    return F.coalesce(first_group(address, r"\b(\d{4})\b\s*$"), first_group(address, r"\b(\d{4})\b"))


def number_key(number: Column) -> Column:
    return F.lower(F.regexp_replace(number, "[^A-Za-z0-9]", ""))


def house_number_of(address: Column) -> Column:
    street = trimmed(F.element_at(F.split(address, ",", -1), 1))
    return number_key(first_group(street, r"^([\d]+[a-z]?(?:\s*-\s*\d+[a-z]?)?)\s+", 1, True))


def street_matches(candidate: Column, wanted: Column) -> Column:
    """Either name contains the other, or the wanted head word (3+ letters) is a word of the candidate."""
    found = plain_words(candidate)
    head = F.element_at(F.split(wanted, " ", -1), 1)
    usable = candidate.isNotNull() & (candidate != "") & wanted.isNotNull() & (wanted != "")
    hit = F.contains(found, wanted) | F.contains(wanted, found) | (
        (F.length(head) > 2) & F.array_contains(F.split(found, " ", -1), head)
    )
    return F.coalesce(usable & hit, F.lit(False))


def listing_id_of_key(key: Column) -> Column:
    """Listing id of a media object key; null for look-alike paths."""
    return first_group(key, MEDIA_KEY)


def image_path(listing_id: Column, file: Column) -> Column:
    return F.concat(F.lit("/images/listings/"), listing_id, F.lit("/"), file)


def photo_paths(listing_id: Column, files: Column) -> Column:
    """``array<struct<src, thumb>>``, display order kept; the first one is the hero."""
    return F.transform(
        files,
        lambda f: F.struct(
            image_path(listing_id, f).alias("src"),
            image_path(listing_id, F.regexp_replace(f, r"\.webp$", ".thumb.webp")).alias("thumb"),
        ),
    )


def locality_query(suburb: Column, postcode: Column, state: Column) -> Column:
    return F.format_string("%s, %s %s, Australia", suburb, state, postcode)


def size_display(value: Column, unit: Column) -> Column:
    """Value and unit; the unit may be plain text, a JSON object holding its text, or missing (m²)."""
    nested = F.coalesce(
        *[F.get_json_object(unit, f"$.{name}") for name in ("displayValue", "display", "value")]
    )
    label = F.when(unit.startswith("{"), F.coalesce(nested, F.lit("m²"))).otherwise(F.coalesce(unit, F.lit("m²")))
    return F.when(value.isNotNull() & (value != ""), F.concat(value, label))


def keyword_hit(property_text: Column, address: Column, keywords: list[str]) -> Column:
    """First keyword (list order) that starts a word of the property type or the address, else null."""
    hay = F.concat_ws(" ", F.coalesce(property_text, F.lit("")), F.coalesce(address, F.lit("")))
    special = set(".*+?^${}()|[]\\")
    chain = None
    for keyword in keywords:
        literal = "".join("\\" + c if c in special else c for c in keyword.strip())
        hit = hay.rlike(java(r"\b", True) + literal)
        chain = F.when(hit, F.lit(keyword)) if chain is None else chain.when(hit, F.lit(keyword))
    return F.lit(None).cast("string") if chain is None else chain
