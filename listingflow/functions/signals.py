"""Named text signals with evidence.

A rule table becomes one array expression; each hit carries a quote with 30 characters of context. A
rule is skipped on texts without its stems: an exact shortcut, because whatever its pattern matches
contains one of every group of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .patterns import all_groups, bind, collapsed, java, matches, replace_all, trimmed
from .text import weekly_rent

# ---- Fixed values: rule tables ------------------------------------------------------------
HOUSE_PART_ROOM = (
    r"(?:lounge|living|dining|laundry|storage|study|media|rumpus|utility|bike|sun|games|mud|powder|bath|bed|family"
    r"|meals|store|drying|plant|theatre|guest|linen|box|court|club|common|parcel|mail)"
)
AMENITY_NOUN = (
    r"(?:kitchens?|bathrooms?|laundr(?:y|ies)|bedrooms?|toilets?|yards?|gardens?|pools?|terraces?|lounges?"
    r"|balcon(?:y|ies))"
)
UP_TO_TWO_ADJECTIVES = rf"(?:(?!{AMENITY_NOUN}\b)\w+[\s,-]+){{0,2}}"

ROOM_SIGNALS = [
    ("shared_kitchen", rf"\b(?:shar(?:e|ed|ing)|communal|common)\s+{UP_TO_TWO_ADJECTIVES}kitchen"),
    ("shared_bathroom", rf"\b(?:shar(?:e|ed|ing)|communal|common)\s+{UP_TO_TWO_ADJECTIVES}bathroom"),
    ("shared_facilities", r"\bshar(?:e|ed|ing)\s+(?:the\s+)?(?:facilit|amenit)"),
    ("share_house", r"\bshar(?:e|ed)[-\s]?(?:house|home|apartment|accommodation)\b"),
    ("co_living", r"\bco[-\s]?living\b"),
    ("boarding_house", r"\b(?:boarding\s*house|hostel|dormitor)"),
    ("per_room", r"\bper\s+room\b"),
    ("per_person", r"\bper\s+person\b"),
    ("room_rent", r"\broom\s+rent\b|\beach\s+room\s+(?:rent|from|is|costs?|\$)"),
    ("room_only", r"\broom\s+only\b"),
    ("room_for_rent", r"\brooms?\s+(?:for|to)\s+(?:rent|lease)\b"),
    ("rooms_available", r"\b(?:\d{1,2}\s+)?rooms?\s+(?:are\s+)?(?:still\s+)?available\b"),
    ("private_room", r"\bprivate\s+room\b|\broom\s+type\s*:"),
    ("lockable_room", r"\block(?:able|ed)\s+(?:private\s+)?rooms?\b|\bprivate\s+lockable\b"),
    ("master_room", r"\bmaster\s+room\b"),
    ("flatmate", r"\b(?:flat\s?mates?|house\s?mates?|room\s?mates?)\b"),
    ("n_rooms", r"\bconsists?\s+of\s+\d{1,2}\s+rooms\b|\b\d{1,2}\s+rooms\s+in\s+total\b"),
    (
        "offered_room",
        r"\b(?:furnished|affordable|single|spacious|quiet|renovated|air[\s-]?conditioned|well[\s-]?presented"
        rf"|extra[\s-]?large|master|double)\s+(?!{HOUSE_PART_ROOM}\b)rooms?\b",
    ),
]
# Of every group one part occurs in whatever the rule matches. Plain text has single spaces, so parts may span words.
_ANY_ROOM = ["room"]
ROOM_STEMS = {
    "shared_kitchen": [["kitchen"], ["shar", "communal", "common"]],
    "shared_bathroom": [["bathroom"], ["shar", "communal", "common"]],
    "shared_facilities": [["facilit", "amenit"], ["shar"]],
    "share_house": [["share"], ["house", "home", "apartment", "accommodation"]],
    "co_living": [["coliving", "co-living", "co living"]],
    "boarding_house": [["boarding house", "boardinghouse", "hostel", "dormitor"]],
    "per_room": [_ANY_ROOM, ["per room"]], "per_person": [["per person"]],
    "room_rent": [_ANY_ROOM, ["room rent", "each room"]], "room_only": [_ANY_ROOM, ["room only"]],
    "room_for_rent": [_ANY_ROOM, ["room for ", "rooms for ", "room to ", "rooms to "]],
    "rooms_available": [_ANY_ROOM, ["available"]], "private_room": [_ANY_ROOM, ["private room", "room type"]],
    "lockable_room": [["lockable", "locked"], ["room", "private"]], "master_room": [_ANY_ROOM, ["master room"]],
    "flatmate": [["flatmate", "flat mate", "housemate", "house mate", "roommate", "room mate"]],
    "n_rooms": [_ANY_ROOM, [" rooms"], ["consist", "rooms in total"]], "offered_room": [_ANY_ROOM, [" room"]],
}
ROOM_ADDRESS = r"^\s*(?:room|rm)\s*\.?\s*\d"
SHARED_HOUSE_MIN_BEDS, SHARED_HOUSE_MAX_PW = 5, 500
ROOM_LOOSE = r"\bshar\w*|\brooms?\b|\bcommunal\b|\bcommon\b|\bboarding\b|\bkitchenette\b|\bbedsit\b"
ROOM_LOOSE_CONTEXT = 26
ROOM_LOOSE_STEMS = ["room", "shar", "commun", "common", "boarding", "kitchenette", "bedsit"]

NOT_A_STUDIO_OFFER = [
    r"\b(?:not|isn'?t|is\s+not|rather\s+than|no)\s+(?:just\s+|merely\s+|simply\s+|your\s+average\s+|an\s+ordinary\s+)?"
    r"(?:an?\s+)?studios?\b",
    r"\bstudios?[-\s]?(?:like|style[d]?|sized?|esque)\b",
    r"\b(?:like|than|unlike|beyond|compared\s+to)\s+an?\s+studios?\b",
    r"\b(?:art|artist'?s?|yoga|pilates|dance|fitness|recording|music|photography|design|film|tattoo|hair|nail|beauty)"
    r"\s+studios?\b",
]
NOT_A_STUDIO_STEMS = [
    [[" studio"], ["no", "isn", "rather"]], [["like", "style", "size", "esque"]],
    [[" studio"], ["like", "than", "beyond", "compared"]], [[" studio"]],
]
STUDIO_LEAD = (
    "this|the|a|an|our|each|every"
    "|furnished|unfurnished|spacious|quiet|modern|renovated|refurbished"
    "|stylish|large|small|cosy|cozy|private|premium|immaculate|neat"
    "|charming|bright|sunny|new|lockable|self-contained|open-plan"
)
STUDIO_SIGNALS = [
    (
        "studio_dwelling",
        r"\bstudios?\s+(?:apartments?|units?|flats?|residences?|suites?|homes?|pads?|rooms?|accommodation)\b",
    ),
    ("studio_headline", r"^\s*studios?\b"),
    ("studio_spec", r"\bstudios?\s*[|·•]"),
    ("studios_offered", r"\bstudios\b"),
    ("studio_offered", rf"\b(?:{STUDIO_LEAD})\s+(?:(?!\bstudios?\b)[\w'’-]+[\s,-]+){{0,4}}studio\b"),
    ("bedsit", r"\bbed[\s-]?sit(?:ter)?s?\b"),
]
# Blanked-out text may have longer runs of spaces: these parts are without.
STUDIO_STEMS = {
    "studio_dwelling": [["studio"]], "studio_headline": [["studio"]], "studio_spec": [["studio"], ["|", "·", "•"]],
    "studios_offered": [["studios"]], "studio_offered": [["studio"]], "bedsit": [["bed"], ["sit"]],
}
STUDIO_TYPE_SIGNAL, STUDIO_TYPE_QUOTE = "rea_property_type", "REA property type: "
STUDIO_LOOSE, STUDIO_LOOSE_CONTEXT = "studio", 40
STUDIO_LOOSE_STEMS = ["studio"]

LEASED = "leased|under application|deposit taken|application approved"
QUOTE_CONTEXT = 30
# -------------------------------------------------------------------------------------------


def plain_text(description: Column) -> Column:
    """Markup and entities out, white space collapsed."""

    def without_markup(t: Column) -> Column:
        return F.when(F.contains(t, F.lit("<")), replace_all(t, r"<[^>]+>", " ")).otherwise(t)

    def without_entities(t: Column) -> Column:
        spaced = replace_all(t, "&nbsp;", " ", True)
        return F.when(F.contains(t, F.lit("&")), replace_all(spaced, "&amp;", "&", True)).otherwise(t)

    return collapsed(bind(bind(F.coalesce(description, F.lit("")), without_markup), without_entities))


def quote_around(text: Column, start: Column, length: Column, context: int = QUOTE_CONTEXT) -> Column:
    """The match with context, elided ends marked; ``start`` is 1-based."""
    first = F.greatest(F.lit(1), start - context)
    last = F.least(F.length(text), start + length - 1 + context)
    return F.concat(
        F.when(first > 1, F.lit("…")).otherwise(F.lit("")),
        trimmed(F.substring(text, first, last - first + 1)),
        F.when(last < F.length(text), F.lit("…")).otherwise(F.lit("")),
    )


def _hit(signal: str, quote: Column) -> Column:
    return F.struct(F.lit(signal).alias("signal"), quote.alias("quote"))


def _first_hit(signal: str, compiled: str, searched: Column, quoted: Column) -> Column:
    """The first match with its quote, else null. The pattern runs once to find the place and once more for what it says."""

    def quoted_at(start: Column) -> Column:
        length = F.length(F.regexp_extract(searched, compiled, 0))
        return F.when(start > 0, bind(length, lambda size: _hit(signal, quote_around(quoted, start, size))))

    return bind(F.regexp_instr(searched, F.lit(compiled)), quoted_at)


def _holds(lowered: Column, stems: list[list[str]]) -> Column:
    """Whether a part of every group occurs: plain substring tests, far cheaper than a pattern."""
    every = None
    for group in stems:
        one = F.contains(lowered, F.lit(group[0]))
        for stem in group[1:]:
            one = one | F.contains(lowered, F.lit(stem))
        every = one if every is None else every & one
    return every


def _rule_hits(rules: list[tuple[str, str]], stems: dict[str, list[list[str]]], lowered: Column, searched: Column,
               quoted: Column, ignore_case: bool) -> Column:
    """Hits in rule order. A rule runs only on texts holding its stems."""
    hits = []
    for signal, pattern in rules:
        compiled = java(pattern, ignore_case)
        hits.append(F.when(_holds(lowered, stems[signal]), _first_hit(signal, compiled, searched, quoted)))
    return F.array_compact(F.array(*hits))


def room_evidence(text: Column, address: Column, price: Column, bedrooms: Column) -> Column:
    """``array<struct<signal, quote>>`` of reasons to think a listing is one room, in rule order.

    ``text``: the plain text of the description.
    """

    def prose(t: Column) -> Column:
        return _rule_hits(ROOM_SIGNALS, ROOM_STEMS, t, t, t, False)

    by_address = F.when(matches(address, ROOM_ADDRESS, True), _hit("room_address", address))
    crowded = (bedrooms >= SHARED_HOUSE_MIN_BEDS) & (weekly_rent(price) < SHARED_HOUSE_MAX_PW)
    by_price = F.when(
        crowded, _hit("beds_vs_price", F.concat(bedrooms.cast("string"), F.lit(" bedrooms at "), price))
    )
    return F.concat(bind(F.lower(text), prose), F.array_compact(F.array(by_address, by_price)))


def masked(text: Column, pattern: str, stems: list[list[str]]) -> Column:
    """Every match blanked by as many spaces, so offsets stay those of ``text``."""
    compiled = java(pattern, True)

    def weave(t: Column) -> Column:
        blanks = F.transform(all_groups(t, pattern, 0, True), lambda m: F.repeat(F.lit(" "), F.length(m)))
        pieces = F.split(t, compiled, -1)
        woven = F.flatten(F.zip_with(pieces, blanks, lambda piece, blank: F.array(piece, blank)))
        return F.when(bind(F.lower(t), lambda low: _holds(low, stems)) & t.rlike(compiled), F.array_join(woven, "")).otherwise(t)

    return bind(text, weave)


def studio_offers(text: Column) -> Column:
    """``text`` with the uses of the word that offer no studio blanked out."""

    def blanked(t: Column) -> Column:
        out = t
        for pattern, stems in zip(NOT_A_STUDIO_OFFER, NOT_A_STUDIO_STEMS, strict=True):
            out = masked(out, pattern, stems)
        return F.when(F.contains(F.lower(t), F.lit("studio")), out).otherwise(t)

    return bind(text, blanked)


def studio_evidence(property_text: Column, text: Column) -> Column:
    """Studio signals: the structured type first, then the prose. ``text``: the plain text of the description."""
    typed = F.when(
        matches(property_text, r"\bstudio", True),
        _hit(STUDIO_TYPE_SIGNAL, F.concat(F.lit(STUDIO_TYPE_QUOTE), property_text)),
    )

    def prose(t: Column) -> Column:
        return bind(
            studio_offers(t),
            lambda offers: bind(
                F.lower(offers), lambda low: _rule_hits(STUDIO_SIGNALS, STUDIO_STEMS, low, offers, t, True)
            ),
        )

    return F.concat(F.array_compact(F.array(typed)), bind(F.trim(text), prose))


def with_evidence(rows: DataFrame, description: str, property_text: str, address: str, price: str,
                  bedrooms: str) -> DataFrame:
    """Add ``room_evidence`` and ``studio_evidence`` from the whole description."""
    # The plain text is a column of its own: read by both it is made once, and whoever asks for one kind runs no rule of
    # the other.
    text = F.col("_plain")
    return rows.withColumn("_plain", plain_text(F.col(description))).withColumns(
        {
            "room_evidence": room_evidence(text, F.col(address), F.col(price), F.col(bedrooms)),
            "studio_evidence": studio_evidence(F.col(property_text), text),
        }
    ).drop("_plain")


def signal_names(evidence: Column) -> Column:
    return F.transform(evidence, lambda e: e["signal"])


def loose_quotes(text: Column, pattern: str, context: int, most: int = 3, stems: list[str] | None = None) -> Column:
    """The first ``most`` distinct surroundings of a loose pattern: what a reviewer should look at. Whatever matches holds one
    of the ``stems``, if given."""
    compiled = java(pattern, True)

    def offsets(t: Column) -> Column:
        found = all_groups(t, pattern, 0, True)
        gaps = F.zip_with(
            F.split(t, compiled, -1), found,
            lambda piece, m: F.struct(F.length(piece).alias("gap"), F.length(m).alias("size")),
        )
        # Where match i starts: the gaps up to i and the matches before it.
        return F.aggregate(
            F.filter(gaps, lambda g: g["size"].isNotNull()),
            F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<at:int,size:int>>").alias("marks")),
            lambda acc, g: F.struct(
                (acc["next"] + g["gap"] + g["size"]).alias("next"),
                F.array_append(acc["marks"], F.struct((acc["next"] + g["gap"]).alias("at"), g["size"].alias("size")))
                .alias("marks"),
            ),
        )["marks"]

    def quotes(t: Column) -> Column:
        def around(m: Column) -> Column:
            first = F.greatest(F.lit(1), m["at"] - context)
            return F.concat(
                F.lit("…"), trimmed(F.substring(t, first, m["at"] + m["size"] + context - first)), F.lit("…")
            )

        shown = F.slice(F.array_distinct(F.transform(offsets(t), around)), 1, most)
        found = t.rlike(compiled) if stems is None else bind(F.lower(t), lambda low: _holds(low, [stems])) & t.rlike(compiled)
        return F.when(found, shown).otherwise(F.array().cast("array<string>"))

    return bind(text, quotes)
