"""Personal data replaced by surrogates that keep type, format, script and gender.

Everything is built from Spark's own functions.

**Entities.**  E-mail and IP addresses, telephone, card, bank account and social-security
numbers, and names after a form of address (which gives the gender) or title.  A name is
taken word by word, parts of words joined by hyphens or apostrophes too, so that ``Mr.
John Smith``, ``Mrs. Smith-Jones`` and ``Dr. Smith`` share the family name; particles (``de
la``, ``von``) and single letters stay.

*Addresses*: e-mail with letters of any script; version 4; version 6 with eight groups or
shortened, of which all spellings are one entity.  *Account numbers* (IBAN) need right
check digits and get right ones.  *Social-security numbers* are grouped by hyphens, or
follow ``SSN``.  Not found: names without a form of address before them, postal addresses,
dates of birth, and numbers that nothing marks as one of the above.

*Telephone numbers* are international ones (``+``, 7 to 15 digits, grouped freely or not
at all), North American ones without ``+1`` (which are the same entity as with it), and
national ones that begin with a grouped ``0``.  The country code follows from the digits;
a trunk ``(0)`` is not part of the number.  Of a run without ``+`` and grouping nothing
says that it is a telephone number.  *Card numbers* are 16 digits in fours, and 13 to 19
digits, grouped or not, whose check digit is right.

**Surrogates.**  An entity's *canonical* form (lower case, or digits only) is mapped by a
keyed hash to another canonical form of the same type: digits to digits, letters to
letters, names to names of the same script and gender.  An address keeps its valid range,
a card number its check digit, a telephone number its country code, an e-mail address its
top-level domain.  The replacement is then written in the format of the place it stands
in (punctuation, capitals), so all spellings of an entity get the same surrogate.

**Collision checks.**  The distinct entities get surrogates; where two have the same one,
or a surrogate is itself an entity, all but the first of them try again with the next
attempt, until there are no collisions.  Only the entities in question take part in a
further round, and a late attempt makes the surrogate longer.  Texts are rewritten in
place with the first attempt; only texts that hold an entity with a later one are looked
up in a table, by the digest of the text.

Defined cases: a null text stays null, an empty one empty; repeated rows and texts are
replaced alike; an empty table gives an empty result; other columns keep their values
whatever they are called (only one named as the result is replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.text import unused
from pageloom.plans.staging import stage

# Forms of address, by gender.
MALE = "Mr|Herr|Monsieur|Señor|Sir|Господин|Κύριος"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mademoiselle|Señora|Señorita|Госпожа|Κυρία"

NEUTRAL = "Dr|Prof|Professor|Доктор"
# Lower-case words inside names, which stay.
PARTICLES = "de|del|della|di|da|dos|das|du|van|von|vom|der|den|la|le|el|al|bin|ibn|ter|ten|zu|zum|zur|af|av"

EMAIL = r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++@[\p{L}0-9-]++(?:\.[\p{L}0-9-]++)+"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Version 6: all eight groups, or a shortened one that begins as such addresses do.
IP6 = (
    rf"(?<![0-9A-Za-z:.])(?:(?:{_HEX}:){{7}}{_HEX}"
    r"|(?:[23][0-9A-Fa-f]{3}|[Ff][CcDd][0-9A-Fa-f]{2}|[Ff][Ee][89ABab][0-9A-Fa-f])"
    rf"(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![0-9A-Za-z:])"
)
# Countries that use international bank account numbers.
IBAN_COUNTRY = (
    "AD|AE|AL|AT|AZ|BA|BE|BG|BH|BR|BY|CH|CR|CY|CZ|DE|DK|DO|EE|EG|ES|FI|FO|FR|GB|GE|GI|GL|GR|GT|HR|HU|"
    "IE|IL|IQ|IS|IT|JO|KW|KZ|LB|LC|LI|LT|LU|LV|LY|MC|MD|ME|MK|MR|MT|MU|NL|NO|PK|PL|PS|PT|QA|RO|RS|"
    "SA|SC|SE|SI|SK|SM|ST|SV|TL|TN|TR|UA|VA|VG|XK"
)
IBAN = (
    rf"(?<![0-9A-Za-z])(?:{IBAN_COUNTRY})[0-9]{{2}}(?:(?: [0-9A-Z]{{4}}){{2,7}}(?: [0-9A-Z]{{1,3}})?"
    r"|[0-9A-Z]{11,30})(?![0-9A-Za-z])"
)
IP = (
    r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}"
    r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"
)
# Country codes with one length of the numbers after them, so that a number
# that follows in the text is not taken along; and all country codes.
LENGTHS = {10: "1|7|30|52|90|91", 9: "31|33|34|41|48|61|351|420", 8: "45|47|65"}
COUNTRY = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
_GAP = "[ ./\u00a0\u2010\u2011-]"
#: What may stand before a digit, and a trunk prefix that is not dialled.
_DIGIT = rf"(?:{_GAP}|\){_GAP}?|{_GAP}?\()?[0-9]"
_TRUNK = rf"(?:{_GAP}?\(0\))?"
PHONE = (
    r"(?<![0-9A-Za-z+])\+(?:"
    + "|".join(rf"(?:{c}){_TRUNK}(?:{_DIGIT}){{{n}}}(?![0-9])" for n, c in LENGTHS.items())
    + r"|[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
    rf"|[1-9](?:{_DIGIT}){{6,14}}(?<![ \u00a0][0-9])(?![0-9]))"
)
_FREE = r"(?<![0-9A-Za-z+])(?<![0-9][.,/-])"
NATIONAL = (
    rf"{_FREE}(?:(?:1{_GAP})?(?:\([2-9][0-9]{{2}}\){_GAP}?|[2-9][0-9]{{2}}{_GAP})[2-9][0-9]{{2}}{_GAP}?[0-9]{{4}}"
    rf"|0[1-9](?:{_GAP}[0-9]{{2}}){{4}}"
    rf"|(?=[(0-9./ -]{{10}})(?:\(0[1-9][0-9]{{0,2}}\){_GAP}?|0[1-9][0-9]{{0,2}}{_GAP})[0-9]{{3,4}}{_GAP}?[0-9]{{3,4}}"
    rf"|(?:\(0[1-9][0-9]{{3}}\){_GAP}?|0[1-9][0-9]{{3}}{_GAP})[0-9]{{3}}{_GAP}?[0-9]{{2,3}}"
    r")(?![0-9A-Za-z]|[.,/-][0-9])"
)
#: Sixteen digits in fours, with or without three more; those, alone or not, in other groups.
CARD = (
    r"(?<![0-9])(?:[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{3}(?![0-9]|[.-][0-9]| [0-9]+[ .-][0-9]|[@A-Za-z_%+])"
    r"|[0-9]{4}(?:[ -]?[0-9]{4}){3}(?![0-9])|[0-9]{13,19}(?![0-9])"
    r"|[0-9]{4}[ -](?:[0-9]{6}[ -][0-9]{3,6}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{1,3}|[0-9]{4}[ -][0-9]{5,6}"
    r"|[0-9]{5}[ -][0-9]{4,5})(?![0-9]|[.-][0-9]))"
)
FOURS = r"^[0-9]{4}(?:[ -]?[0-9]{4}){3}(?:[ -]|$)"
SSN = (
    r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
    r"|(?:(?<=SSN )|(?<=SSN: )|(?<=SSN:))[0-9]{3} ?[0-9]{2} ?[0-9]{4}(?![0-9-])"
)
SSN_FORM = r"[0-9]{3}([ -]?)[0-9]{2}\1[0-9]{4}"
_TITLES = rf"(?:(?:{MALE}|{FEMALE}|{NEUTRAL})\.? )+"
_WORD = r"\p{Lu}(?:\p{L}+(?:['\u2019-]\p{L}+)*|(?:['\u2019-]\p{L}+)+)"
_NAMED = rf"(?:(?:{PARTICLES}) )*{_WORD}"
NAME = rf"(?<!\p{{L}}){_TITLES}{_NAMED}(?: (?:\p{{Lu}}\. )?{_NAMED}){{0,2}}"
#: What of a name is replaced: runs of two letters or more that are no particles.
TOKEN = rf"(?<!\p{{L}})(?!(?:{PARTICLES})(?![\p{{L}}'\u2019-]))\p{{L}}{{2,}}"
#: What every entity holds; most texts hold none of it and are not searched further.
HINT = rf"[0-9@]|(?<!\p{{L}})(?:{MALE}|{FEMALE}|{NEUTRAL})"
ANY = "|".join(f"(?:{p})" for p in (EMAIL, IP6, IBAN, IP, PHONE, SSN, CARD, NATIONAL, NAME))

#: From this attempt on, surrogates get longer.
LONGER = 8
MAX_ATTEMPTS = 64

# Syllables of made-up names, by script.
SYLLABLES = {
    "latin": "ba be bi bo da de di do fa fe ga ge ha he jo ka ke ko la le li lo ma me mi mo na ne ni no "
    "pa pe ra re ri ro sa se si so ta te ti to va ve vi vo".split(),
    "cyrillic": "ба бе бо ва ве ви га го да де ди до за ка ке ко ла ле ли ло ма ме ми мо на не ни но "
    "па пе ра ре ри ро са се си со та те ти то".split(),
    "greek": "βα βε βο γα γε δα δε δι δο κα κε κο λα λε λι λο μα με μι μο να νε νι νο πα πε ρα ρε ρι ρο "
    "σα σε σι σο τα τε τι το".split(),
}
#: Endings of given names, male and female, and of family names.
ENDINGS = {
    "latin": ("n", "a", "s"),
    "cyrillic": ("н", "а", "в"),
    "greek": ("ς", "α", "ς"),
}

_EMPTY = "CAST(array() AS array<struct<kind: string, canon: string>>)"


def _with(value: Column, body) -> Column:
    """``body(value)``, where ``value`` is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def kind_of(value: Column) -> Column:
    whole = lambda p: value.rlike(f"^(?:{p})$")
    return (
        F.when(value.contains("@"), "email")
        .when(whole(NAME), "name")
        .when(value.startswith("+"), "phone")
        .when(whole(IP), "ip")
        .when(whole(IP6), "ip6")
        .when(value.rlike("^[A-Z]"), "iban")
        .when(whole(SSN_FORM), "ssn")
        .when(F.length(_digits(value)) < 13, "phone")
        .otherwise("card")
    )


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def card_digits(value: Column) -> Column:
    """The digits of a card number, null if these are none."""
    digits = _digits(value)
    right = F.length(digits).between(13, 19) & (luhn_sum(digits) % 10 == 0)
    return F.when(right, digits).when(value.rlike(FOURS), F.substr(digits, F.lit(1), F.lit(16)))


def _dialled(value: Column) -> Column:
    """A telephone number with its trunk prefix ``(0)`` as one character."""
    return F.when(value.startswith("+"), F.replace(value, F.lit("(0)"), F.lit("\x1f"))).otherwise(value)


def phone_canon(value: Column) -> Column:
    """Country code (``0`` if the number does not tell it) and all digits."""
    digits = _digits(_dialled(value))
    code = F.regexp_extract(digits, f"^(?:{COUNTRY})", 0)
    full = F.when(F.length(digits) == 10, F.concat(F.lit("1"), digits)).otherwise(digits)
    return (
        F.when(value.startswith("+"), F.concat(code, F.lit(":"), digits))
        .when(digits.startswith("0"), F.concat(F.lit("0:"), digits))
        .otherwise(F.concat(F.lit("1:"), full))
    )


def script_of(word: Column) -> Column:
    return (
        F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic")
        .when(word.rlike(r"\p{IsGreek}"), "greek")
        .otherwise("latin")
    )


def _name_rest(value: Column) -> Column:
    """A name without the forms of address before it."""
    return F.regexp_replace(value, f"^{_TITLES}", "")


def name_words(value: Column) -> Column:
    """The words of a name that hold something to replace."""
    return F.filter(F.split(_name_rest(value), " "), lambda w: w.rlike(TOKEN))


def groups_of_ip6(value: Column) -> Column:
    """An address of version 6 as eight groups of four digits."""
    parts = lambda x: F.array_remove(F.split(x, ":"), "")
    left = parts(F.substring_index(value, "::", 1))
    right = F.when(value.contains("::"), parts(F.substring_index(value, "::", -1)))
    right = F.coalesce(right, F.array().cast("array<string>"))
    zeros = F.array_repeat(F.lit("0"), F.greatest(8 - F.size(left) - F.size(right), F.lit(0)))
    return F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.lpad(g, 4, "0")), ":")


def mod97(chars: Column) -> Column:
    """The remainder of a number whose letters stand for 10 to 35."""
    value = lambda c: F.conv(c, 36, 10).cast("int")
    step = lambda s, c: (s * F.when(value(c) > 9, 100).otherwise(10) + value(c)) % 97
    return F.aggregate(_chars(chars), F.lit(0), step)


def iban_canon(value: Column) -> Column:
    """The account number without spaces, null if its check digits are wrong."""
    packed = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(packed, F.lit(5), F.lit(40)), F.substr(packed, F.lit(1), F.lit(4)))
    fits = F.length(packed).between(15, 34)
    return F.when(fits & (mod97(turned) == 1), packed)


def entities(value: Column) -> Column:
    """The ``(kind, canon)`` parts of one match, in order."""
    return _with(kind_of(value), lambda kind: _parts(value, kind))


def _parts(value: Column, kind: Column) -> Column:
    words = name_words(value)
    gender = F.when(value.rlike(rf"^(?:{MALE})\b"), "male").when(value.rlike(rf"^(?:{FEMALE})\b"), "female")
    given = F.concat(F.lit("given_"), F.coalesce(gender, F.lit("any")))
    names = F.flatten(
        F.transform(
            words,
            lambda w, i: F.transform(
                F.regexp_extract_all(w, F.lit(TOKEN), F.lit(0)),
                lambda t: F.struct(
                    F.concat(
                        F.when(i == F.size(words) - 1, "family").otherwise(given), F.lit("_"), script_of(t)
                    ).alias("kind"),
                    F.lower(t).alias("canon"),
                ),
            ),
        )
    )
    canon = (
        F.when(kind.isin("email"), F.lower(value))
        .when(kind == "ip", value)
        .when(kind == "ip6", F.lower(groups_of_ip6(value)))
        .when(kind == "iban", iban_canon(value))
        # a telephone number keeps its country code, so that is part of its type
        .when(kind == "phone", phone_canon(value))
        .when(kind == "card", card_digits(value))
        .otherwise(_digits(value))
    )
    one = F.array(F.struct(kind.alias("kind"), canon.alias("canon")))
    return F.when(kind == "name", names).otherwise(F.filter(one, lambda e: e["canon"].isNotNull()))


def is_entity(value: Column) -> Column:
    """Whether a match is an entity; a long number without a right check digit is none."""
    kind = kind_of(value)
    checked = F.when(kind == "card", card_digits(value)).when(kind == "iban", iban_canon(value))
    return ~kind.isin("card", "iban") | checked.isNotNull()


def matches(text: Column) -> Column:
    none = F.array().cast("array<string>")
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    return F.when(text.rlike(HINT), found).otherwise(none)


def _byte(h: Column, i) -> Column:
    """The ``i``-th byte of a hash of 64 bytes in hex (counted on from its start)."""
    at = F.pmod(F.lit(i) if isinstance(i, int) else i, F.lit(64)) * 2 + 1
    return F.conv(F.substr(h, at, F.lit(2)), 16, 10).cast("int")


def _chars(value: Column) -> Column:
    return F.array_remove(F.split(value, ""), "")


_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_CYRILLIC = "абвгдежзиклмнопрстуфхцчшэюя"
_GREEK = "αβγδεζηθικλμνξοπρστυφχψω"


def _like(value: Column, h: Column) -> Column:
    """Digits for digits, letters for letters of the script, everything else as it is."""

    def one(c: Column, i: Column) -> Column:
        letter = lambda a: F.substr(F.lit(a), F.pmod(_byte(h, i), F.lit(len(a))) + 1, F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), F.pmod(_byte(h, i), F.lit(10)).cast("string"))
            .when(c.rlike(r"\p{IsCyrillic}"), letter(_CYRILLIC))
            .when(c.rlike(r"\p{IsGreek}"), letter(_GREEK))
            .when(c.rlike(r"[\p{L}\p{M}]"), letter(_LETTERS))
            .otherwise(c)
        )

    return F.array_join(F.transform(_chars(value), one), "")


def luhn_sum(digits: Column) -> Column:
    """Sum of a number's digits in which every second one from the right is doubled."""
    doubled = F.transform(
        F.reverse(_chars(digits)),
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
            c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x)


def _syllable(syllables: list[str], h: Column):
    table = F.array(*[F.lit(s) for s in syllables])
    return lambda i: F.get(table, F.pmod(_byte(h, i), F.lit(len(syllables))))


def surrogate(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogate of an entity at an attempt."""
    h = F.sha2(
        F.concat_ws("\x1f", F.lit(key), kind, canon, attempt.cast("string")).cast("binary"), 512
    )
    longer = F.when(attempt >= LONGER, attempt.cast("string")).otherwise("")
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    top = F.concat(F.lit("."), F.substring_index(domain, ".", -1))
    name = F.substr(domain, F.lit(1), F.length(domain) - F.length(top))
    other = F.sha2(h, 512)
    email = F.concat(_like(local, h), longer, F.lit("@"), _like(name, other), top)
    ip = F.concat_ws(".", *[(1 + F.pmod(_byte(h, i), F.lit(254))).cast("string") for i in range(4)])
    code = F.substring_index(canon, ":", 1)
    rest = F.substr(F.substring_index(canon, ":", -1), F.length(code) + 1)
    phone = F.concat(code, F.lit(":"), code, _like(rest, h))
    body = _like(F.substr(canon, F.lit(1), F.length(canon) - 1), h)
    check = F.pmod(10 - luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
    last = F.when(luhn_sum(canon) % 10 == 0, check).otherwise(F.pmod(check + 1 + _byte(h, 63) % 9, F.lit(10)))
    card = F.concat(body, last.cast("string"))
    hexes = F.transform(F.sequence(F.lit(4), F.lit(31)), lambda i: F.substr(h, i + 1, F.lit(1)))
    ip6 = F.concat(F.substr(canon, F.lit(1), F.lit(4)), F.array_join(hexes, ""))
    ip6 = F.regexp_replace(ip6, "(.{4})(?=.)", "$1:")
    country = F.substr(canon, F.lit(1), F.lit(2))
    account = F.upper(_like(F.lower(F.substr(canon, F.lit(5), F.lit(40))), h))
    iban = F.concat(
        country, F.lpad((98 - mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account
    )
    made = None
    for script, syllables in SYLLABLES.items():
        n = F.lit(3) + F.when(attempt >= LONGER, attempt - LONGER + 1).otherwise(0)
        stem = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), _syllable(syllables, h)), "")
        male, female, family = ENDINGS[script]
        end = F.when(kind.startswith("given_male"), male).when(kind.startswith("given_female"), female)
        value = F.concat(stem, end.otherwise(family))
        is_script = kind.endswith(f"_{script}")
        made = F.when(is_script, value) if made is None else made.when(is_script, value)
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "ip6", ip6)
        .when(kind == "iban", iban)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "ssn", _like(canon, h))
        .otherwise(made)
    )


def _fill(pattern: Column, digits: Column, place: str = "[0-9]") -> Column:
    """The digits written into the places of the pattern's digits."""
    return F.aggregate(
        _chars(pattern),
        F.struct(F.lit(1).alias("i"), F.lit("").alias("out")),
        lambda s, c: F.struct(
            (s["i"] + c.rlike(place).cast("int")).alias("i"),
            F.concat(
                s["out"], F.when(c.rlike(place), F.substr(digits, s["i"], F.lit(1))).otherwise(c)
            ).alias("out"),
        ),
        lambda s: s["out"],
    )


def _cased(word: Column, like: Column) -> Column:
    return F.when((F.length(like) > 1) & (like == F.upper(like)), F.upper(word)).otherwise(F.initcap(word))


def written(value: Column, found: Column) -> Column:
    """A match with its surrogates (``found``, one per part) in its own format."""
    return _with(
        F.struct(kind_of(value).alias("kind"), found.alias("found")),
        lambda x: _written(value, x["kind"], x["found"]),
    )


def _written(value: Column, kind: Column, found: Column) -> Column:
    first = F.get(found, 0)
    upper = (value == F.upper(value)) & value.rlike("[A-Z]")
    rest = _name_rest(value)
    new = F.zip_with(
        F.regexp_extract_all(rest, F.lit(TOKEN), F.lit(0)), found, lambda w, s: _cased(F.coalesce(s, w), w)
    )
    between = F.split(rest, TOKEN, -1)
    names = F.concat(
        F.regexp_extract(value, f"^{_TITLES}", 0),
        F.array_join(F.zip_with(between, F.concat(new, F.array(F.lit(""))), lambda b, n: F.concat(b, n)), ""),
    )
    short = F.array_join(F.transform(F.split(first, ":"), lambda g: F.regexp_replace(g, "^0{1,3}", "")), ":")
    plain, number = _dialled(value), F.substring_index(first, ":", -1)
    # without its country code a number has the last digits only
    last = F.substr(number, F.length(number) - F.length(_digits(plain)) + 1, F.length(number))
    # digits after a card number stay
    after = F.substr(_digits(value), F.length(first) + 1, F.length(value))
    return (
        F.when(first.isNull(), value)
        .when(kind == "email", F.when(upper, F.upper(first)).otherwise(first))
        .when(kind == "ip", first)
        .when(kind == "ip6", F.when(value.rlike("[A-F]"), F.upper(short)).otherwise(short))
        .when(kind == "iban", _fill(value, first, "[0-9A-Z]"))
        .when(kind == "phone", F.replace(_fill(plain, last), F.lit("\x1f"), F.lit("(0)")))
        .when(kind == "name", names)
        .when(kind == "card", _fill(value, F.concat(first, after)))
        .otherwise(_fill(value, first))
    )


def surrogates(found: DataFrame, key: str) -> DataFrame:
    """``(kind, canon, attempt, surrogate)`` without collisions.

    ``found`` is a staged table of distinct entities.
    """
    a = F.col("attempt")
    current = found.withColumn("attempt", F.lit(0))
    current = stage(current.withColumn("surrogate", surrogate(F.col("kind"), F.col("canon"), a, key)), "surrogates")
    for _ in range(MAX_ATTEMPTS):
        # within each surrogate the entity with the earliest attempt, then the first, keeps it
        order = F.struct("attempt", F.sha2(F.concat_ws("\x1f", F.lit(key), "canon"), 256), "canon")
        keeper = (
            current.groupBy("kind", "surrogate")
            .agg(F.count("*").alias("n"), F.min(order)["canon"].alias("keeper"))
            .where("n > 1")
            .select(F.col("kind").alias("k"), F.col("surrogate").alias("s"), "keeper")
        )
        real = found.select(F.col("kind").alias("k2"), F.col("canon").alias("c2"))
        again = (
            current.join(keeper, (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("s")), "left")
            .join(real, (F.col("kind") == F.col("k2")) & (F.col("surrogate") == F.col("c2")), "left")
            .where((F.col("keeper") != F.col("canon")) | F.col("c2").isNotNull())
            .select("kind", "canon", F.lit(True).alias("again"))
        )
        again = stage(again, "collisions")
        if again.isEmpty():
            return current
        moved = current.join(again, ["kind", "canon"], "left").withColumn(
            "attempt", a + F.coalesce("again", F.lit(False)).cast("int")
        )
        moved = moved.withColumn(
            "surrogate",
            F.when(F.col("again"), surrogate(F.col("kind"), F.col("canon"), a, key)).otherwise(F.col("surrogate")),
        )
        current = stage(moved.select("kind", "canon", "attempt", "surrogate"), "surrogates")
    raise RuntimeError(f"surrogates still collide after {MAX_ATTEMPTS} attempts")


def replace(docs: DataFrame, out: str, *, key: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``out``: ``text`` and ``n_entities``."""
    own, body = unused(docs, f"{out}__", prefix=True), F.col(text)
    parts = F.flatten(F.transform(matches(body), entities))
    # the digest before the rows, so that no row carries the text; outer, as a plain
    # explode adds a filter for which the text would be searched twice
    found_in = docs.select(F.md5(body.cast("binary")).alias("digest"), parts.alias("parts"))
    spread = found_in.select("digest", F.explode_outer("parts").alias("e")).where("e IS NOT NULL")
    spread = stage(spread.select("digest", "e.kind", "e.canon"), "entities")
    table = surrogates(stage(spread.select("kind", "canon").distinct(), "distinct"), key)
    late = table.where("attempt > 0").select("kind", "canon", "surrogate")
    of_text = stage(
        spread.distinct()
        .join(late, ["kind", "canon"])
        .groupBy("digest")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "canon"), "surrogate"))
            ).alias("late")
        ),
        "late",
    ).select(F.struct("*").alias(f"{own}late"))
    theirs = F.col(f"`{own}late`")
    m = f"{own}m"  # used more than once, so it stays a column
    joined = docs.withColumn(m, matches(body)).join(
        of_text, F.md5(body.cast("binary")) == theirs["digest"], "left"
    )

    def one(value: Column) -> Column:
        found = F.transform(
            entities(value),
            lambda e: F.coalesce(
                F.element_at(theirs["late"], F.concat_ws("\x1f", e["kind"], e["canon"])),
                surrogate(e["kind"], e["canon"], F.lit(0), key),
            ),
        )
        return written(value, found)

    found = F.col(f"`{m}`")
    pieces = F.split(body, ANY, -1)
    new = F.concat(F.transform(found, one), F.array(F.lit("")))
    rewritten = F.when(F.size(found) == 0, body).otherwise(
        F.array_join(F.zip_with(pieces, new, lambda p, m: F.concat(p, m)), "")
    )
    n = F.when(F.size(found) <= 0, F.size(found)).otherwise(F.size(F.filter(found, is_entity)))
    return joined.withColumn(
        out, F.struct(F.when(body.isNotNull(), rewritten).alias("text"), n.alias("n_entities"))
    ).drop(f"{own}late", m)


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every document with its personal data replaced."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    x = replace(docs, "r", key="surrogates")
    return x.select("doc_id", F.col("r.text").alias("text"), F.col("r.n_entities").cast("long").alias("n_entities"))
