"""Format-preserving pseudonyms of personal data. DataFrame functions only.

A value is split in two halves and sent through a keyed Feistel network whose
rounds add to one half a hash of the other, each half modulo the number of values it
may have. That permutes the values of a format among themselves: a valid value
becomes a valid one, different values stay different, and equal values become equal
wherever they stand, so documents stay linked.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringwatch.llm.common import free_name

ROUNDS = 8

# What is looked for; every alternative decides at a character within a bounded
# number of steps, so very long texts cost no more per character than short ones.
EMAIL = (
    r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{M}\p{N}-]{1,63}+\.){1,8}\p{L}{2,24}"
)
# Account numbers; fixed values: the countries that have them. The check digits decide.
IBAN_LANDS = (
    "AD AE AL AT AZ BA BE BG BH BR BY CH CR CY CZ DE DK DO EE EG ES FI FO FR GB GE GI GL GR GT HR HU IE IL IQ IS IT "
    "JO KW KZ LB LC LI LT LU LV LY MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SC SE SI SK SM ST SV TL TN TR "
    "UA VA VG XK"
).split()
IBAN = (
    rf"(?<![0-9A-Za-z])(?:{'|'.join(IBAN_LANDS)})[0-9]{{2}}(?:[0-9A-Z]{{11,30}}+"
    r"|(?:\x20[0-9A-Z]{4}){2,7}(?:\x20[0-9A-Z]{1,3})?)(?![0-9A-Za-z])"
)
# Tokens that are known by how they begin, which stays.
TOKEN_HEAD = r"(?:(?i:bearer)[\x20\t]{1,3}|AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|sk-|xox[abprs]-)"
TOKEN = (
    r"(?<![0-9A-Za-z_-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|(?:gh[pousr]_|github_pat_|glpat-|sk-|xox[abprs]-)[0-9A-Za-z_-]{16,}+"
    r"|(?i:bearer)[\x20\t]{1,3}(?=[^\s0-9]{0,255}+[0-9]|\S{40})[0-9A-Za-z._~+/=-]{16,}+)(?![0-9A-Za-z])"
)
# A value goes on to its closing quote or to white space, without an upper bound. Possessive
# runs are read in a loop and never given back. An unquoted value ends before a quote that
# closes something around it, before the next name in a list and before a tag; it needs a
# digit, unless it is longer than any word.
SECRET_NAME = (
    r"(?i:password|passwd|pwd|secret|token|api[_-]?key)(?:\\?[\x22'])?[\x20\t]{0,3}[=:][\x20\t]{0,3}"
)
SECRET_TEXT = (
    r"(?:[^\s\x22'&;,<]|[\x22'](?![,;:}\])>\s]|$)|[&;,](?![A-Za-z_][A-Za-z0-9_-]{0,31}[\x22']?[=:])"
    r"|<(?!/?[A-Za-z][A-Za-z0-9]{0,15}[\x20]?/?>)){8,}+"
)
SECRET = (
    rf"{SECRET_NAME}(?:\x22(?:[^\x22\\\r\n]|\\.)++|'(?:[^'\\\r\n]|\\.)++|\\[\x22'][^\x22'\\\r\n]++"
    rf"|(?![\x22'\\])(?=[^\s0-9]{{0,255}}+[0-9]|\S{{256}}){SECRET_TEXT})"
)
IPV4 = r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
MONTH = (
    r"(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:tember)?|Oct(?:ober)?"
    r"|Nov(?:ember)?|Dec(?:ember)?)"
)
# A time may follow an ISO date.
DATE = (
    r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?=[Tt][0-9]{2}|[Zz](?![0-9A-Za-z])|(?![0-9A-Za-z/-]))"
    r"|(?:[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}"
    rf"|[0-9]{{1,2}}\x20{MONTH},?\x20[0-9]{{4}}|{MONTH}\x20[0-9]{{1,2}},?\x20[0-9]{{4}})(?![0-9A-Za-z/-]))"
)
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
# What a number behind a plus sign does not run into: a date, or a card.
_APART = (
    rf"(?![\x20-](?:{DATE}|[0-9]{{13,19}}(?![0-9])|[0-9]{{4}}(?:[\x20-][0-9]{{4}}){{3}}|[0-9]{{4}}[\x20-][0-9]{{6}}[\x20-][0-9]{{5}}))"
)
_NANP = r"(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}"
_GAP = r"(?:[\x20./-]|[\x20.-]?\(|\)[\x20.-]?)?"
PHONE = (
    rf"(?<![0-9A-Za-z+])(?:\+1[\x20.-]?{_NANP}|\+(?!1[\x20.-]?{_NANP}(?![0-9A-Za-z]))[1-9](?:{_APART}{_GAP}[0-9]){{6,14}}"
    r"|(?:\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})|\([0-9]{3}\)|[0-9]{3}(?=[.-]))"
    r"[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4})(?![0-9A-Za-z])"
)
# National numbers, which cards are looked for before: ten digits, whole or with spaces, or behind a trunk zero.
LOCAL = (
    r"(?<![0-9A-Za-z+])(?<![0-9][.,])(?:1?[2-9][0-9]{9}|[2-9][0-9]{2}\x20[0-9]{3}[\x20.-][0-9]{4}"
    r"|0[1-9](?:\x20?[0-9]){6,10}|0[1-9][0-9]{1,3}[/-][0-9]{3,8}(?:\x20[0-9]{2,5})?)(?![0-9A-Za-z]|[.,][0-9])"
)
# A run of digit groups, in which cards are looked for; it ends before a date, number or phone of its own.
CARD = (
    r"(?<![0-9A-Za-z])(?=(?:[\x20-]?[0-9]){13})[0-9]++(?![A-Za-z])"
    rf"(?:(?![\x20-](?:{DATE}|{SSN}|{PHONE}))[\x20-][0-9]++(?![A-Za-z]))*+"
)
KINDS = {
    "email": EMAIL, "secret": SECRET, "token": TOKEN, "iban": IBAN, "ipv4": IPV4, "date": DATE, "ssn": SSN, "phone": PHONE, "card": CARD,
    "local": LOCAL,
}
ANY = "|".join(f"(?:{pattern})" for pattern in KINDS.values())
#: No alternative matches a text without one of these.
NEEDED = r"[0-9@]|(?i:passw|pwd|secret|token|api[_-]?key|bearer)|gh[pousr]_|glpat-|sk-|xox[abprs]-"

# The days that are taken for personal dates, and the area numbers
# that are never issued.
FIRST_DAY, DAYS = "1900-01-01", 73_049
DAY_PARTS, DAY_STEPS = (229, 319), 128
CARD_DIGITS = (13, 19)
SSN_AREAS, SSN_SKIPPED = 898, 666


def _whole(pattern: str) -> str:
    """The alternative's pattern for a value standing alone."""
    return rf"^(?:{pattern})$"


def _digest(key: str | Column, tag: str, turn: Column, value: Column, bits: int = 256) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), turn.cast("string"), value), bits)


def _number(key: str | Column, tag: str, turn: Column, value: Column) -> Column:
    """52 bits of the keyed hash."""
    return F.conv(F.substring(_digest(key, tag, turn, value.cast("string")), 1, 13), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, lefts: Column, rights: Column, key: str | Column, tag: str) -> Column:
    """Struct ``l, r``: a keyed permutation of [0, lefts) x [0, rights)."""
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def turn(state: Column, i: Column) -> Column:
        on_left = (i % 2) == 1
        l, r = state["l"], state["r"]
        moved_l = F.pmod(l + _number(key, tag, i, r), lefts)
        moved_r = F.pmod(r + _number(key, tag, i, l), rights)
        return F.struct(
            F.when(on_left, moved_l).otherwise(l).alias("l"), F.when(on_left, r).otherwise(moved_r).alias("r")
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _power(n: Column) -> Column:
    return F.pow(F.lit(10.0), n).cast("bigint")


def _permuted_digits(digits: Column, key: str | Column, tag: str | Column) -> Column:
    """As many digits again; up to 18 of them."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    left, right = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1, n - half)
    named = F.concat_ws("/", F.lit(tag), n.cast("string"))
    start = F.struct(
        left.cast("bigint").alias("l"), right.cast("bigint").alias("r"), named.alias("tag"),
        half.alias("half"), (n - half).alias("rest"),
    )
    # The sizes ride along in the state, so they are worked out once per value.
    moved = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda s, i: F.struct(
            F.when(i % 2 == 1, F.pmod(s["l"] + _tagged(key, s["tag"], i, s["r"]), _power(s["half"])))
            .otherwise(s["l"]).alias("l"),
            F.when(i % 2 == 0, F.pmod(s["r"] + _tagged(key, s["tag"], i, s["l"]), _power(s["rest"])))
            .otherwise(s["r"]).alias("r"),
            s["tag"].alias("tag"), s["half"].alias("half"), s["rest"].alias("rest"),
        ),
        lambda s: F.concat(
            F.lpad(s["l"].cast("string"), s["half"], F.lit("0")), F.lpad(s["r"].cast("string"), s["rest"], F.lit("0"))
        ),
    )
    return moved


def _tagged(key: str | Column, tag: Column, turn: Column, value: Column) -> Column:
    hashed = F.sha2(F.concat_ws("|", F.lit(key), tag, turn.cast("string"), value.cast("string")), 256)
    return F.conv(F.substring(hashed, 1, 13), 16, 10).cast("bigint")


def _laid_out(value: Column, digits: Column, replaced: str = "^[0-9]$") -> Column:
    """``value`` with its digits, or what else is ``replaced``, replaced in order by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"), digits.alias("new"))

    def put(state: Column, c: Column) -> Column:
        is_digit = c.rlike(replaced)
        taken = F.when(is_digit, F.substr(state["new"], state["at"], F.lit(1))).otherwise(c)
        return F.struct(
            F.concat(state["out"], taken).alias("out"),
            (state["at"] + F.when(is_digit, 1).otherwise(0)).alias("at"), state["new"].alias("new"),
        )

    return F.aggregate(F.regexp_extract_all(value, F.lit("(?s)."), 0), start, put, lambda s: s["out"])


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, every second one from the right doubled."""
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _card(value: Column, key: str | Column) -> Column:
    """All digits but the last are permuted, and the last set so that the number is valid again."""
    digits = _digits(value)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)

    def closed(new: Column) -> Column:
        check = F.pmod(10 - luhn_sum(F.concat(new, F.lit("0"))) % 10, F.lit(10))
        return F.concat(new, check.cast("string"))

    valid = luhn_sum(digits) % 10 == 0
    fresh = F.transform(F.array(_permuted_digits(body, key, "card")), closed)[0]
    return F.when(valid, _laid_out(value, fresh)).otherwise(value)


def _pieces(value: Column, is_hit: bool) -> Column:
    return F.array(F.struct(value.alias("t"), F.lit(is_hit).alias("hit")))


def _cards_of(run: Column) -> Column:
    """Pieces ``t, hit`` of a run of digit groups: the valid cards in it and what stands between them.

    A card may be any 13 to 19 digits from the start of one group to the end of
    another. Taken is the first one, the longest of those that start there.
    """
    low, high = CARD_DIGITS

    def longest(groups: Column, i: Column) -> Column:
        """How many groups from the i-th make the longest card; 0 if none do."""
        def longer(s: Column, j: Column) -> Column:
            more = F.concat(s["d"], F.substr(_digits(F.get(groups, j)), F.lit(1), F.lit(high + 1)))

            def tested(d: Column) -> Column:
                valid = F.length(d).between(low, high) & (luhn_sum(d) % 10 == 0)
                return F.struct(d.alias("d"), F.when(valid, j - i + 1).otherwise(s["n"]).alias("n"))

            return F.when(F.length(s["d"]) >= high, s).otherwise(F.transform(F.array(more), tested)[0])

        start = F.struct(F.lit("").alias("d"), F.lit(0).alias("n"))
        last = F.least(i + high - 1, F.size(groups) - 1)
        return F.aggregate(F.sequence(i, last), start, longer, lambda s: s["n"])

    def picked(groups: Column) -> Column:
        found = F.transform(
            F.sequence(F.lit(0), F.size(groups) - 1),
            lambda i: F.struct(i.alias("at"), (i + longest(groups, i)).alias("end")),
        )
        none = F.array().cast("array<struct<at:int,end:int>>")

        def pick(s: Column, x: Column) -> Column:
            free = F.when(F.size(s) > 0, F.element_at(s, -1)["end"]).otherwise(0)
            return F.when(x["at"] >= free, F.concat(s, F.array(x))).otherwise(s)

        return F.aggregate(F.filter(found, lambda x: x["end"] > x["at"]), none, pick)

    def laid(s: Column) -> Column:
        groups, cards = s["groups"], s["cards"]

        def text(start: Column, end: Column) -> Column:
            return F.array_join(F.slice(groups, start + 1, end - start), "")

        def piece(x: Column, k: Column) -> Column:
            before = F.when(k > 0, F.get(cards, k - 1)["end"]).otherwise(0)
            card = text(x["at"], x["end"])
            # The separator behind the last group is not the card's.
            return F.concat(
                _pieces(text(before, x["at"]), False), _pieces(F.rtrim(card, F.lit(" -")), True),
                _pieces(F.regexp_extract(card, "[\\x20-]?$", 0), False),
            )

        tail = F.element_at(cards, -1)["end"]
        return F.concat(F.flatten(F.transform(cards, piece)), _pieces(text(tail, F.size(groups)), False))

    groups = F.regexp_extract_all(run, F.lit("[0-9]+[\\x20-]?"), 0)
    cut = F.transform(F.array(groups), lambda g: F.struct(g.alias("groups"), picked(g).alias("cards")))
    return F.transform(cut, lambda s: F.when(F.size(s["cards"]) > 0, laid(s)).otherwise(_pieces(run, False)))[0]


# The country codes of one and of two digits; all others have three.
ONE_DIGIT_CODES = ["1", "7"]
TWO_DIGIT_CODES = (
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 "
    "90 91 92 93 94 95 98"
).split()


def _phone(value: Column, key: str | Column) -> Column:
    """Another number of the same layout, the same for all layouts of one number.

    The country code and the first digit behind it stay, as do a trunk zero and the digit behind it. Of
    ten-digit numbers, with or without the code 1, the first digits of area and exchange stay.
    """
    def part(text: Column, start: int, size: int | None = None) -> Column:
        return F.substr(text, F.lit(start), F.lit(size)) if size else F.substr(text, F.lit(start))

    def moved(s: Column) -> Column:
        digits = s["digits"]
        n = F.length(digits)
        code = (
            F.when(part(digits, 1, 1).isin(ONE_DIGIT_CODES), part(digits, 1, 1))
            .when(part(digits, 1, 2).isin(TWO_DIGIT_CODES), part(digits, 1, 2)).otherwise(part(digits, 1, 3))
        )
        ten = part(digits, 1, 1).isin(list("23456789")) & (n == 10) & ~s["plus"]
        national = F.when((part(digits, 1, 1) == "1") & (n == 11), part(digits, 2)).when(ten, digits)

        def of_ten(x: Column) -> Column:
            body = _permuted_digits(F.concat(part(x, 2, 2), part(x, 5)), key, "phone/1")
            fresh = F.transform(F.array(body), lambda y: F.concat(part(x, 1, 1), part(y, 1, 2), part(x, 4, 1), part(y, 3)))[0]
            return F.concat(F.substr(digits, F.lit(1), n - 10), fresh)

        kept = F.when(s["plus"], F.length(code) + 1).when(part(digits, 1, 1) == "0", 2).otherwise(1)
        tag = F.concat(F.lit("phone/"), F.when(s["plus"], F.concat(F.lit("+"), code)).when(part(digits, 1, 1) == "0", "0").otherwise(""))
        other = F.concat(F.substr(digits, F.lit(1), kept), _permuted_digits(F.substr(digits, kept + 1), key, tag))
        return F.coalesce(F.when(national.isNotNull(), of_ten(national)), other)

    start = F.struct(_digits(value).alias("digits"), value.startswith("+").alias("plus"))
    return _laid_out(value, F.transform(F.array(start), moved)[0])


def mod97(text: Column) -> Column:
    """The number that the text is, letters counting from A = 10, modulo 97."""
    def add(rest: Column, c: Column) -> Column:
        letter = F.instr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c)
        return F.when(letter > 0, (rest * 100 + letter + 9) % 97).otherwise((rest * 10 + c.cast("int")) % 97)

    return F.aggregate(F.regexp_extract_all(text, F.lit("."), 0), F.lit(0), add)


def _iban(value: Column, key: str | Column) -> Column:
    """The country stays; the rest is permuted within letters and digits, and the check digits are set anew."""
    whole = F.replace(value, F.lit(" "), F.lit(""))
    land, body = F.substr(whole, F.lit(1), F.lit(2)), F.substr(whole, F.lit(5))
    valid = mod97(F.concat(body, F.substr(whole, F.lit(1), F.lit(4)))) == 1

    def closed(new: Column) -> Column:
        check = F.lpad((98 - mod97(F.concat(new, land, F.lit("00")))).cast("string"), 2, "0")
        return F.concat(land, check, new)

    fresh = F.transform(F.array(permuted_text(body, key, "iban", hexes=False)), closed)[0]
    return F.when(valid, _laid_out(value, fresh, "^[0-9A-Z]$")).otherwise(value)


def _token(value: Column, key: str | Column) -> Column:
    """What stands after the beginning that tells what it is."""
    head = F.regexp_extract(value, rf"^{TOKEN_HEAD}", 0)
    return F.concat(head, permuted_text(F.substr(value, F.length(head) + 1), key, "secret"))


def _ipv4(value: Column, key: str | Column) -> Column:
    octets = F.transform(F.split(value, r"\."), lambda x: x.cast("bigint"))
    valid = F.forall(F.split(value, r"\."), lambda x: (x.cast("int") <= 255) & (x.cast("int").cast("string") == x))
    moved = feistel(
        octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], F.lit(65536), F.lit(65536), key, "ipv4"
    )
    fresh = F.transform(
        F.array(moved),
        lambda m: F.concat_ws(
            ".", F.shiftright(m["l"], 8).cast("string"), (m["l"] % 256).cast("string"),
            F.shiftright(m["r"], 8).cast("string"), (m["r"] % 256).cast("string"),
        ),
    )[0]
    return F.when(valid, fresh).otherwise(value)


def _moved_day(number: Column, key: str | Column) -> Column:
    """Another day of the domain, after the 12th of its month if this one is.

    The network is applied again until it comes to such a day, which permutes those
    days among themselves. So a date that is no MM/dd is never written as one that
    could be, and equal dates stay equal in all layouts.
    """
    lefts, rights = DAY_PARTS

    def late(n: Column) -> Column:
        return F.day(F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))) > 12

    def step(s: Column, _: Column) -> Column:
        moved = feistel(F.floor(s["n"] / rights), s["n"] % rights, F.lit(lefts), F.lit(rights), key, "date")
        fresh = F.transform(F.transform(F.array(moved), lambda m: m["l"] * rights + m["r"]), lambda n: F.struct(
            n.alias("n"), s["late"].alias("late"), ((n < DAYS) & (late(n) == s["late"])).alias("done")
        ))[0]
        return F.when(s["done"], s).otherwise(fresh)

    start = F.struct(number.cast("bigint").alias("n"), late(number).alias("late"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(DAY_STEPS)), start, step, lambda s: s["n"])


def _date(value: Column, key: str | Column) -> Column:
    """Days from 1900 to 2099, in the order of year, month and day that they are written in.

    With slashes the month is first unless that gives no date.
    """
    def read(layout: str) -> Column:
        return F.try_to_timestamp(value, F.lit(layout)).cast("date")

    slashed = [("^[0-9]{2}/[0-9]{2}/", "MM/dd/yyyy", "dd/MM/yyyy"), ("^[0-9]{1,2}/", "M/d/yyyy", "d/M/yyyy")]
    plain = [
        ("-", "yyyy-MM-dd"), (r"^[0-9]{2}\.[0-9]{2}\.", "dd.MM.yyyy"), (r"\.", "d.M.yyyy"),
        ("^[0-9]{4}/[0-9]{2}/[0-9]{2}$", "yyyy/MM/dd"), ("^[0-9]{4}/", "yyyy/M/d"),
    ]
    layouts = []
    for month, letters in (("MMM", "{2}"), ("MMMM", "{2,8}")):
        for day, digits in (("dd", "{2}"), ("d", "{1}")):
            for comma in (",", ""):
                plain.append((f"^[0-9]{digits} [A-Z][a-z]{letters}{comma} ", f"{day} {month}{comma} yyyy"))
                plain.append((f"^[A-Z][a-z]{letters} [0-9]{digits}{comma} ", f"{month} {day}{comma} yyyy"))
    choice = None
    for pattern, form in plain:
        choice = F.when(value.rlike(pattern), form) if choice is None else choice.when(value.rlike(pattern), form)
        layouts.append(form)
    for pattern, first, second in slashed:
        choice = choice.when(value.rlike(pattern), F.when(read(first).isNotNull(), first).otherwise(second))
        layouts += [first, second]

    def replaced(s: Column) -> Column:
        number = s["number"]
        valid = F.coalesce((number >= 0) & (number < DAYS), F.lit(False))
        written = F.transform(
            F.array(_moved_day(number, key)),
            lambda n: F.coalesce(*[
                F.when(s["layout"] == x, F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int")), x))
                for x in layouts
            ]),
        )[0]
        return F.when(valid, written).otherwise(value)

    day = F.coalesce(*[F.when(choice == x, read(x)) for x in layouts])
    start = F.struct(F.datediff(day, F.lit(FIRST_DAY).cast("date")).alias("number"), choice.alias("layout"))
    return F.transform(F.array(start), replaced)[0]


def _ssn(value: Column, key: str | Column) -> Column:
    part = F.split(value, "-")
    area, group, serial = (part[i].cast("bigint") for i in range(3))
    valid = (area > 0) & (area < 900) & (area != SSN_SKIPPED) & (group > 0) & (serial > 0)
    place = area - 1 - F.when(area > SSN_SKIPPED, 1).otherwise(0)
    moved = feistel(place, (group - 1) * 9999 + serial - 1, F.lit(SSN_AREAS), F.lit(99 * 9999), key, "ssn")

    def write(m: Column) -> Column:
        number = m["l"] + 1 + F.when(m["l"] + 1 >= SSN_SKIPPED, 1).otherwise(0)
        return F.concat_ws(
            "-", F.lpad(number.cast("string"), 3, "0"),
            F.lpad((F.floor(m["r"] / 9999) + 1).cast("string"), 2, "0"),
            F.lpad((m["r"] % 9999 + 1).cast("string"), 4, "0"),
        )

    return F.when(valid, F.transform(F.array(moved), write)[0]).otherwise(value)


_HEX = "0123456789abcdef"
# Letters that change places among themselves: ASCII, Latin, Greek and Cyrillic ones of each case.
_SETS = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789",
    *("".join(chr(c) for c in range(a, z + 1) if chr(c).isalpha() and chr(c) not in "ªº×÷") for a, z in (
        (0xDF, 0xFF), (0xC0, 0xDE), (0x3B1, 0x3C9), (0x391, 0x3A9), (0x430, 0x44F), (0x410, 0x42F),
    )),
    "".join(chr(c) for c in range(0x100, 0x180) if chr(c).islower()), "".join(chr(c) for c in range(0x100, 0x180) if chr(c).isupper()),
)


def _moved_on(c: Column, by: Column, is_hex: Column) -> Column:
    """The character ``by`` places further in its set; others stay."""
    def inside(letters: str) -> Column:
        place = F.instr(F.lit(letters), c) - 1
        return F.substr(F.lit(letters), (F.pmod(place + by, F.lit(len(letters))) + 1).cast("int"), F.lit(1))

    found = F.when(is_hex, inside(_HEX))
    for letters in _SETS:
        found = found.when(F.instr(F.lit(letters), c) > 0, inside(letters))
    return found.otherwise(c)


def permuted_text(value: Column, key: str | Column, tag: str, hexes: bool = True) -> Column:
    """Letters become letters of their case, digits digits, the rest stays; lower-case hex stays hex, unless ``hexes`` is false.

    A Feistel network on the halves of the text: a round moves every character of one
    half on by a number drawn from the other, which keeps each character's set.
    """
    n = F.length(value)
    half = F.floor(n / 2).cast("int")
    start = F.struct(
        F.substr(value, F.lit(1), half).alias("l"), F.substr(value, half + 1).alias("r"),
        (value.rlike(f"^[{_HEX}]+$") if hexes else F.lit(False)).alias("is_hex"),
    )

    def shifted(text: Column, digest: Column, is_hex: Column) -> Column:
        def moved(stream: Column) -> Column:
            def one(c: Column, j: Column) -> Column:
                octet = F.substr(stream, (F.pmod(j, F.lit(64)) * 2 + 1).cast("int"), F.lit(2))
                return _moved_on(c, F.conv(octet, 16, 10).cast("int"), is_hex)

            return F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s)."), 0), one), "")

        # The digest is taken once, not once per character.
        return F.transform(F.array(digest), moved)[0]

    def turn(s: Column, i: Column) -> Column:
        on_left = i % 2 == 1
        left = shifted(s["l"], _digest(key, tag, i, s["r"], 512), s["is_hex"])
        right = shifted(s["r"], _digest(key, tag, i, s["l"], 512), s["is_hex"])
        return F.struct(
            F.when(on_left, left).otherwise(s["l"]).alias("l"),
            F.when(on_left, s["r"]).otherwise(right).alias("r"), s["is_hex"].alias("is_hex"),
        )

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda s: F.concat(s["l"], s["r"])
    )


def _email(value: Column, key: str | Column) -> Column:
    """The name before the @; the domain stays."""
    at = F.instr(value, "@")
    return F.concat(permuted_text(F.substr(value, F.lit(1), at - 1), key, "email"), F.substr(value, at))


def _secret(value: Column, key: str | Column) -> Column:
    """What stands after the equals sign or colon; marks behind an unquoted value are not part of it."""
    name = F.regexp_extract(value, rf"^{SECRET_NAME}(?:\\?[\x22'])?", 0)
    rest = F.substr(value, F.length(name) + 1)
    quoted = F.substr(name, F.length(name)).isin('"', "'")
    secret = F.when(quoted, rest).otherwise(F.rtrim(rest, F.lit(".,;:!?)]}>\"'")))
    return F.concat(name, permuted_text(secret, key, "secret"), F.substr(rest, F.length(secret) + 1))


def pseudonym(value: Column, key: str | Column) -> Column:
    """The pseudonym of one found value; a number or date that is not valid stays as it is."""
    makers = {
        "email": _email, "secret": _secret, "token": _token, "iban": _iban, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card,
        "local": _phone,
    }
    found = None
    for kind, pattern in KINDS.items():
        mine, fresh = value.rlike(_whole(pattern)), makers[kind](value, key)
        found = F.when(mine, fresh) if found is None else found.when(mine, fresh)
    return found.otherwise(value)


def _locals_of(piece: Column) -> Column:
    """Pieces of what a run holds besides cards: its national phone numbers and the rest."""
    between, found = F.split(piece, LOCAL, -1), F.regexp_extract_all(piece, F.lit(LOCAL), 0)
    return F.flatten(F.zip_with(between, found, lambda p, f: F.concat(
        _pieces(p, False), F.when(f.isNull(), _pieces(F.lit(""), False)).otherwise(_pieces(f, True))
    )))


def values_of(found: Column) -> Column:
    """Pieces of a found text: itself as one value, or the cards and phone numbers of a run of digits."""
    run = F.flatten(F.transform(
        _cards_of(found), lambda x: F.when(x["hit"], F.array(x)).otherwise(_locals_of(x["t"]))
    ))
    return F.when(found.rlike(_whole(CARD)), run).otherwise(_pieces(found, True))


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and the count of changes in ``n_replaced``.

    Replaced are e-mail names, IPv4 addresses, phone numbers, social security numbers,
    payment card numbers and IBANs with valid check digits, dates from 1900 to 2099, values
    of passwords, tokens and keys, and tokens of common shapes. What looks like one but is not valid stays. ``key``
    is the secret: the same key gives the same pseudonyms, in all documents.

    A null text stays null and an empty one empty, with 0 changes. Whole texts are
    read; each row is on its own, so ties, repeated rows and skew have no effect. A
    column ``n_replaced`` of ``docs`` is replaced, all others are kept.
    """
    column = F.col(f"`{text}`")
    columns = docs.columns
    found, pieces, fresh, secret = (free_name(docs, n) for n in ("_found", "_pieces", "_fresh", "_secret"))
    # The key comes from a table of one value, so no plan shows it.
    given = docs.sparkSession.createDataFrame([(key,)], "secret string").scalar()
    docs = docs.withColumn(secret, given)
    hit = column.rlike(NEEDED)
    cut = docs.withColumn(found, F.when(hit, F.regexp_extract_all(column, F.lit(ANY), 0)))
    cut = cut.withColumn(found, F.when(F.size(found) > 0, F.col(found)))
    parts = F.when(F.col(found).isNotNull(), F.split(column, ANY, -1))
    cut = cut.withColumn(pieces, F.flatten(F.zip_with(parts, found, lambda p, f: F.concat(
        _pieces(p, False), F.when(f.isNull(), _pieces(F.lit(""), False)).otherwise(values_of(f))
    ))))
    # A piece that stays has no pseudonym.
    cut = cut.withColumn(fresh, F.transform(pieces, lambda x: F.when(x["hit"], pseudonym(x["t"], F.col(secret)))))
    texts = F.zip_with(pieces, fresh, lambda x, f: F.coalesce(f, x["t"]))
    changes = F.size(F.filter(F.zip_with(pieces, fresh, lambda x, f: x["t"] != f), lambda x: x))
    changed = F.when(F.col(found).isNotNull(), F.array_join(texts, "")).otherwise(column)
    return cut.select(
        *[changed.alias(c) if c == text else F.col(f"`{c}`") for c in columns if c.lower() != "n_replaced"],
        F.coalesce(F.when(F.col(found).isNotNull(), changes), F.lit(0)).cast("bigint").alias("n_replaced"),
    )
