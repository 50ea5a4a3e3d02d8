"""Column functions on text. All stay inside the JVM; null in, null out unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without ASCII white space at both ends."""
    return F.regexp_replace(_c(c), r"^[ \t\n\f\r]+|[ \t\n\f\r]+$", "")


def squeeze(c: Column | str) -> Column:
    """Every run of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(_c(c), r"[ \t\n\f\r]+", " "))


def tokens(c: Column | str) -> Column:
    """The parts between white space; the empty text has none."""
    return F.filter(F.split(_c(c), r"[ \t\n\f\r]+"), lambda w: w != "")


def n_tokens(c: Column | str) -> Column:
    return F.size(tokens(c)).cast("long")


def gate_tokens(c: Column | str) -> Column:
    """Runs of a-z and 0-9 in the lower-cased text."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit("([a-z0-9]+)"), F.lit(1))


def unicode_words(c: Column | str) -> Column:
    """Runs of letters and digits of any script in the lower-cased text."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def rough_tokens(c: Column | str) -> Column:
    """A rough number of model tokens: a quarter of the characters, at least 1."""
    return F.greatest(F.lit(1), F.floor(F.length(_c(c)) / 4)).cast("long")


def ngrams(words: Column, n: int) -> Column:
    """All runs of n words, joined by blanks; none if there are fewer than n. ``words`` should be a column, as it is read for each run."""
    return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))).otherwise(
        F.array().cast("array<string>")
    )


def opener(c: Column | str, n: int = 4) -> Column:
    """The first n words."""
    return F.array_join(F.slice(tokens(c), 1, n), " ")


def overlap(a: Column, b: Column) -> Column:
    """Shared elements over those of the smaller set (overlap coefficient); 0 if either is empty."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    small = F.least(F.size(x), F.size(y))
    return F.when(small > 0, F.size(F.array_intersect(x, y)) / small).otherwise(F.lit(0.0))


def occurrences(text: Column | str, needle: Column | str) -> Column:
    """How often the needle occurs without overlaps; 0 for an empty needle."""
    t, w = _c(text), _c(needle)
    return F.when(F.length(w) > 0, ((F.length(t) - F.length(F.replace(t, w, F.lit("")))) / F.length(w)).cast("long")).otherwise(F.lit(0).cast("long"))


def snippet(text: Column | str, needle: Column | str, around: int = 30) -> Column:
    """The surroundings of the first occurrence, letter case ignored; line breaks as blanks; null if there is none."""
    t, w = _c(text), _c(needle)
    at = F.instr(F.lower(t), F.lower(w))
    begin = F.greatest(F.lit(1), at - around)
    return F.when(at > 0, F.trim(F.regexp_replace(F.substring(t, begin, at + F.length(w) + around - begin), r"[\r\n]", " ")))


def list_join(items: Column) -> Column:
    """a; a and b; a, b, and c; the empty text for none."""
    n = F.size(items)
    return (
        F.when(n <= 0, "")
        .when(n == 1, F.element_at(items, 1))
        .when(n == 2, F.concat(F.element_at(items, 1), F.lit(" and "), F.element_at(items, 2)))
        .otherwise(F.concat(F.array_join(F.slice(items, F.lit(1), n - 1), ", "), F.lit(", and "), F.element_at(items, -1)))
    )


def capped_list(items: Column, most: int = 6) -> Column:
    """``list_join`` of at most so many items, "among others" standing for the rest."""
    n = F.size(items)
    return F.when(n > most, F.concat(F.array_join(F.slice(items, 1, most), ", "), F.lit(", among others"))).otherwise(list_join(items))


def shortened(c: Column | str, longest: int = 60) -> Column:
    """The first characters for display, with three stops where something was cut off."""
    x = _c(c)
    return F.when(F.length(x) > longest, F.concat(F.substring(x, 1, longest), F.lit("..."))).otherwise(x)


def with_article(c: Column | str) -> Column:
    """an before a vowel letter, a before others."""
    x = _c(c)
    return F.concat(F.when(x.rlike("^[aeiouAEIOU]"), "an ").otherwise("a "), x)


def plural(c: Column | str) -> Column:
    """es after an s, s after other letters."""
    x = _c(c)
    return F.concat(x, F.when(x.rlike("[sS]$"), "es").otherwise("s"))


#: Ordinal words; higher ranks are written in digits.
ORDINALS = "first second third fourth fifth sixth seventh eighth ninth tenth".split()


def ordinal(n: Column | str) -> Column:
    """The word for a rank from 1 on, 11th and so on above ten; null below 1."""
    x = _c(n)
    digits = F.concat(x.cast("string"), F.when((x % 100).between(11, 13), "th").when(x % 10 == 1, "st").when(x % 10 == 2, "nd").when(x % 10 == 3, "rd").otherwise("th"))
    return F.when(x.between(1, len(ORDINALS)), F.element_at(F.array(*[F.lit(w) for w in ORDINALS]), x.cast("int"))).when(x > len(ORDINALS), digits)


def first_rule(c: Column | str, rules: list[tuple[str, frozenset[str] | set[str]]], otherwise: str | None = None) -> Column:
    """The first group of the first rule (pattern, words that don't count) that finds one; a rule takes its first match that counts."""
    x, out = _c(c), F.lit(otherwise)
    for pattern, skip in reversed(rules):
        found = F.regexp_extract_all(x, F.lit(pattern), F.lit(1))
        out = F.coalesce(F.get(F.array_except(found, F.array(*[F.lit(w) for w in sorted(skip)])) if skip else found, F.lit(0)), out)
    return out


#: Words that name no topic.
NO_TOPIC = frozenset("device command current other same first last next most some that this which each every".split())
#: What an answer is about, in this order: the subject of its first sentence, the command it names, a name in capitals, a noun after "the".
TOPIC_RULES = [
    (r"^(?:The )?([A-Z][A-Za-z0-9_-]{1,20}(?:[ \t\n\f\r]+(?:sensor|chip|module|controller|camera|radio))?)[ \t\n\f\r]+(?:is|are|uses|has|provides|detects|measures)[ \t\n\f\r]", frozenset()),
    (r"^Type ([A-Za-z0-9_]+)", frozenset()),
    (r"(?:^|[^A-Za-z0-9_])([A-Z][A-Z0-9]{2,}(?:-[A-Za-z0-9_]+)?)(?:$|[^A-Za-z0-9_])", frozenset()),
    (r"(?:^|[^A-Za-z0-9_])[tT]he ([A-Za-z0-9_]{4,})", NO_TOPIC),
]
#: What an answer tells to do: the aim of its command, the command that there isn't, then what is changed.
ACTION_RULES = [
    (r"^(?:Type|Use) [A-Za-z0-9_][A-Za-z0-9_ \t\n\f\r]* to ([^.,]+)", frozenset()),
    (r"(?:^|[^A-Za-z0-9_])no ([A-Za-z0-9_][A-Za-z0-9_ \t\n\f\r]{2,20}?) command", frozenset()),
    (r"(?:^|[^A-Za-z0-9_])((?:clear|delete|remove|reset|update|change|set|configure|enable|disable) (?:the )?[A-Za-z0-9_]+)", frozenset()),
]


def topic_of(c: Column | str) -> Column:
    """The topic of an answer by TOPIC_RULES; null if none applies."""
    return first_rule(c, TOPIC_RULES)


def action_of(c: Column | str) -> Column:
    """The action of an answer by ACTION_RULES, else its topic, in lower case; null if there is neither."""
    return F.lower(F.coalesce(first_rule(c, ACTION_RULES), topic_of(c)))


def typed_commands(c: Column | str) -> Column:
    """What follows the word type, without closing marks; articles and if don't count."""
    found = F.transform(F.regexp_extract_all(_c(c), F.lit(r"(?i)\btype\s+(\S+)"), F.lit(1)), lambda w: F.regexp_replace(w, "[.,;:]+$", ""))
    return F.filter(found, lambda w: (w != "") & ~F.lower(w).isin("the", "if", "a", "an"))


def printable_runs(c: Column | str, least: int = 3) -> Column:
    """The runs of at least so many printable ASCII characters in bytes."""
    return F.regexp_extract_all(F.decode(_c(c), "ISO-8859-1"), F.lit(r"([\x20-\x7E]{%d,})" % least), F.lit(1))


def slug(c: Column | str, longest: int = 50) -> Column:
    """Lower case, runs of other characters than a-z and 0-9 as one hyphen, none at the ends."""
    s = F.regexp_replace(F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.regexp_replace(F.substring(s, 1, longest), "-+$", "")


def capitalize(c: Column | str) -> Column:
    """First letter upper case, the others lower case."""
    x = _c(c)
    return F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30)))


def lead_of(c: Column | str) -> Column:
    """Yes or No if the text begins with that word, a full stop and a body; else null."""
    return F.nullif(F.regexp_extract(_c(c), r"^(Yes|No)\.[ \t\n\f\r]+(?s:.+)$", 1), F.lit(""))


def body_of(c: Column | str) -> Column:
    """The text without such a lead."""
    return F.regexp_replace(_c(c), r"^(?:Yes|No)\.[ \t\n\f\r]+(?=(?s:.))", "")


def verb_led(c: Column | str) -> Column:
    """Whether the text begins with one of the command verbs Type, Run, Use."""
    return squeeze(c).rlike("^(?:Type|Run|Use) .")


def verb_key(c: Column | str) -> Column:
    """The text after a leading command verb, white space squeezed."""
    return F.regexp_replace(squeeze(c), "^(?:Type|Run|Use) (?=.)", "")


def casual(c: Column | str) -> Column:
    """Lower case without closing blanks, question marks and stops."""
    return F.regexp_replace(F.lower(_c(c)), "[ ?.]+$", "")


def fill(template: Column | str, **values: Column | str) -> Column:
    """The template with every {name} replaced; a null value leaves null."""
    out = _c(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{" + k + "}"), _c(v))
    return out


def unescape_token(c: Column | str) -> Column:
    """A byte-level token as text: the signs for blank, line break and tab replaced."""
    x = _c(c)
    for sign, plain in (("Ġ", " "), ("Ċ", "\n"), ("ĉ", "\t")):
        x = F.replace(x, F.lit(sign), F.lit(plain))
    return x
