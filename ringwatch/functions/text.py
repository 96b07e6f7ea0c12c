"""Text functions: mentions, token tickers, names and symbols."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that are never tickers.
SKIP_WORDS = [
    "THE", "FOR", "AND", "NOT", "YOU", "WITH", "ARE", "THIS",
    "WILL", "NEXT", "FROM", "JUST", "HAVE", "THAT", "BEEN",
]
USER_PREFIX = "tw_"
DEFAULT_TARGET = "crypto_community"

# Unicode white space plus the four ASCII separators.
_SPACE = r"(?U)[\s\x1c-\x1f]+"
_SHORT = r"(?<!\p{L})\p{L}{2,8}+(?!\p{L})"
_TICKER = r"^(?=.*\p{IsUppercase})[^\p{IsLowercase}\p{Lt}]+$"


def _words(text: Column) -> Column:
    return F.split(text, _SPACE)


def at_mentions(text: Column) -> Column:
    """Words starting with ``@`` and longer than two characters, without the ``@``."""
    hits = F.filter(_words(text), lambda w: w.startswith("@") & (F.length(w) > 2))
    names = F.transform(hits, lambda w: F.substr(w, F.lit(2)))
    # Most texts have no such sign and need not be cut into words.
    return F.when(text.contains("@"), names).when(text.isNotNull(), F.array().cast("array<string>"))


def first_of(values: Column, limit: int | None) -> Column:
    """The first ``limit`` elements, all of them without a limit."""
    return values if limit is None else F.slice(values, 1, limit)


def _tickers(text: Column) -> Column:
    letters = F.regexp_replace(F.upper(text), r"(?U)[^\p{L}\s\x1c-\x1f]+", "")
    # Only words of the right length are cut out, and most of those are decided by the list.
    short = F.regexp_extract_all(letters, F.lit(_SHORT), 0)
    return F.filter(short, lambda w: ~w.isin(SKIP_WORDS) & w.rlike(_TICKER))


def token_mentions(text: Column, limit: int | None = None) -> Column:
    """Distinct ticker-like words, in order of first appearance.

    A ticker is a word whose letters alone number two to eight, with an upper-case
    and no lower- or title-case letter after upper-casing, and is not a skip word.
    """
    return first_of(F.array_distinct(_tickers(text)), limit)


def first_token(text: Column) -> Column:
    """The first ticker-like word, null without one."""
    return F.get(_tickers(text), F.lit(0))


def targets(mentions: Column, limit: int | None = None) -> Column:
    """The mentioned names, or the community account when there is none."""
    named = F.size(F.coalesce(mentions, F.array().cast("array<string>"))) > 0
    return F.when(named, first_of(mentions, limit)).otherwise(F.array(F.lit(DEFAULT_TARGET)))


def account(name: Column, limit: int | None = None) -> Column:
    """The prefixed name, cut to ``limit`` characters before that if there is a limit."""
    return F.concat(F.lit(USER_PREFIX), name if limit is None else F.substring(name, 1, limit))


def token_symbol(token: Column) -> Column:
    """``shiba-inu`` -> ``SHIBA_INU``."""
    return F.replace(F.upper(token), F.lit("-"), F.lit("_"))


def _without(text: Column, *parts: str) -> Column:
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(""))
    return text


def file_symbol(file_name: Column) -> Column:
    """``coin_Foo_price.csv`` -> ``FOO``."""
    return F.upper(_without(file_name, "coin_", "_price", ".csv"))


def file_coin(file_name: Column) -> Column:
    """Coin label of the statistics report, which keeps a ``coin_`` prefix."""
    return F.upper(_without(file_name, "_price.csv", ".csv"))


def resolved_symbol(symbol: Column, file_name: Column) -> Column:
    """The row's own symbol in upper case, else the one its file name gives."""
    return F.coalesce(F.upper(symbol), file_symbol(file_name))
