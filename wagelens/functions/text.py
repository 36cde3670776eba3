"""Column expressions for posting text: titles, places, pay, skills.

Every function maps columns to a column, so the work stays inside code
generation.  Where an expression uses its input many times (lower-cased text),
the caller passes a column already lowered by an earlier projection; see
``operators.clean``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from wagelens import rules

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"


BLANKS = " \t\n\r\x0b\x0c\u00a0"


def strip(text: Column) -> Column:
    """Text without leading and trailing white space."""
    return F.btrim(text, F.lit(BLANKS))


def any_of(text: Column, words: list[str]) -> Column:
    """True where the text contains at least one of the words."""
    hit = F.lit(False)
    for i, word in enumerate(words):
        found = text.contains(word)
        hit = found if i == 0 else hit | found
    return hit


def any_word_of(text: Column, words: list[str]) -> Column:
    """As ``any_of``, but only at word boundaries."""
    body = "|".join(re.escape(w) for w in words)
    return text.rlike(f"(^|{NOT_WORD})({body})($|{NOT_WORD})")


def first_match(pairs: list[tuple[Column, Column]], default: Column) -> Column:
    """The value of the first condition that holds."""
    chain = None
    for condition, value in pairs:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return default if chain is None else chain.otherwise(default)


def null_texts(text: Column, texts: list[str]) -> Column:
    """NULL where the text is one of the given stand-ins for a missing value."""
    return F.when(text.isin(texts), F.lit(None)).otherwise(text)


def standard_title(lowered: Column, word_boundary: bool = False) -> Column:
    """Title class of a lower-cased title.

    Substring rules hit inside words ("ui" in "recruiter");
    ``word_boundary=True`` asks for whole words instead.
    """
    test = any_word_of if word_boundary else any_of
    pairs = [(lowered.isNull(), F.lit(rules.TITLE_UNKNOWN))]
    pairs += [(test(lowered, words), F.lit(name)) for name, words in rules.TITLE_RULES]
    return first_match(pairs, F.lit(rules.TITLE_OTHER))


def standard_location(location: Column, valid_codes_only: bool = False) -> Column:
    """Two-letter code, named place, country or "Other".

    ``valid_codes_only`` accepts a two-letter hit only if it is a US code, and
    lets other texts fall through to the named places and countries.
    """
    hit = F.regexp_extract(location, rules.LOCATION_PATTERN, 0)
    code = F.when(hit.contains(","), F.trim(F.split(hit, ",")[1])).otherwise(hit)
    accepted = code.isin(rules.US_CODES) if valid_codes_only else hit != ""
    pairs = [(location.isNull(), F.lit(rules.LOCATION_UNKNOWN)), (accepted, code)]
    pairs += [(any_of(location, words), F.lit(name)) for name, words in rules.LOCATION_NAMED]
    pairs += [(location.contains(c), F.lit(c)) for c in rules.COUNTRIES]
    return first_match(pairs, F.lit(rules.LOCATION_OTHER))


def salary_value(salary: Column, reference_mode: bool = False) -> Column:
    """Number in a salary text.

    Corrected mode reads decimals and a K suffix and averages the first two
    numbers.  Reference mode averages all runs of digits and commas, so a
    decimal point splits a number.  A run without a digit is skipped.
    """
    if reference_mode:
        runs = F.regexp_extract_all(salary, F.lit("[0-9,]+"), F.lit(0))
        numbers = F.transform(runs, lambda r: F.replace(r, F.lit(","), F.lit("")).try_cast("double"))
    else:
        runs = F.regexp_extract_all(salary, F.lit(r"[0-9][0-9,]*(?:\.[0-9]+)?[kK]?"), F.lit(0))

        def parse(run: Column) -> Column:
            plain = F.translate(run, ",kK", "").try_cast("double")
            return plain * F.when(F.lower(run).endswith("k"), F.lit(1000.0)).otherwise(F.lit(1.0))

        numbers = F.transform(F.slice(runs, 1, 2), parse)
    numbers = F.filter(numbers, lambda x: x.isNotNull())
    # one pass: sum and size apart would each find and read the numbers anew
    start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("n"))
    mean = F.aggregate(
        numbers, start,
        lambda acc, x: F.struct((acc["total"] + x).alias("total"), (acc["n"] + 1.0).alias("n")),
        lambda acc: F.try_divide(acc["total"], acc["n"]),
    )
    return F.when(~salary.isin(rules.SENTINELS), mean)


def salary_period(lowered: Column) -> Column:
    """Pay period named in a lower-cased salary text."""
    pairs = [(lowered.isNull(), F.lit(rules.PERIOD_UNKNOWN))]
    pairs += [(any_of(lowered, words), F.lit(name)) for name, words in rules.PERIOD_RULES]
    return first_match(pairs, F.lit(rules.PERIOD_UNKNOWN))


def annual_salary(value: Column, period: Column) -> Column:
    """Salary per year; an unknown period is taken as yearly."""
    pairs = [(period == name, value * F.lit(float(k))) for name, k in rules.PERIOD_FACTOR.items()]
    return first_match(pairs, value)


def annual_factor(lowered: Column) -> Column:
    """What turns the pay in a lower-cased salary text into pay per year."""
    pairs = [
        (any_of(lowered, words), F.lit(float(rules.PERIOD_FACTOR.get(name, 1))))
        for name, words in rules.PERIOD_RULES
    ]
    return first_match(pairs, F.lit(1.0))


def salary_text_for_title(lowered: Column) -> Column:
    """Stand-in salary text: first listed title contained in the lower title."""
    pairs = [(lowered.contains(key), F.lit(text)) for key, text in rules.SALARY_TEXT_BY_TITLE]
    return first_match(pairs, F.lit(rules.SALARY_TEXT_DEFAULT))


def skill_pattern(skill: str) -> str:
    """Word-boundary pattern of a skill, free of engine-specific ``\\b``.

    A boundary lies between a word character and anything else, so next to a
    leading or trailing punctuation mark it demands a word character.
    """
    left = f"(^|{NOT_WORD})" if re.match(r"\w", skill[0]) else WORD
    right = f"($|{NOT_WORD})" if re.match(r"\w", skill[-1]) else WORD
    return left + re.escape(skill).replace(r"\ ", " ") + right


def is_plain_word(skill: str) -> bool:
    return re.fullmatch(r"\w+", skill) is not None


def text_array(values: list[str]) -> Column:
    quoted = ["'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values]
    return F.expr(f"array({', '.join(quoted)})") if values else F.expr("cast(array() as array<string>)")


def matched_skills(lowered: Column, vocabulary: list[str] | None = None) -> Column:
    """Skills named in a lower-cased text, in vocabulary order; NULL gives [].

    Plain words are looked up among the tokens, found in one pass over the
    text.  Skills with spaces or punctuation each need a pattern.
    """
    vocabulary = rules.SKILLS if vocabulary is None else vocabulary
    tokens = F.regexp_extract_all(lowered, F.lit(f"{WORD}+"), F.lit(0))
    phrases = [s for s in vocabulary if not is_plain_word(s)]
    seen = tokens
    if phrases:
        hits = [F.when(lowered.contains(s) & lowered.rlike(skill_pattern(s)), F.lit(s)) for s in phrases]
        seen = F.concat(tokens, F.array(*hits))
    return F.coalesce(F.array_intersect(text_array(vocabulary), seen), text_array([]))


def fallback_skills(lowered: Column) -> Column:
    """Default skills of a text that names none, by ordered substring rules."""
    pairs = []
    for groups, skills in rules.FALLBACK_SKILLS:
        condition = any_of(lowered, groups[0])
        for group in groups[1:]:
            condition = condition & any_of(lowered, group)
        pairs.append((condition, text_array(skills)))
    return first_match(pairs, text_array([]))


def slug(skill: str) -> str:
    """Column-safe name of a skill: "c++" -> "c_plus_plus", "ci/cd" -> "ci_slash_cd"."""
    names = {"+": " plus ", "#": " sharp ", ".": " dot ", "/": " slash ", "-": " dash "}
    spelled = "".join(names.get(ch, ch) for ch in skill)
    return re.sub(r"\W+", "_", spelled.strip()).strip("_")


def search_url(term: Column) -> Column:
    """Search address of a term: blanks become %20."""
    head, tail = rules.SEARCH_URL
    return F.concat(F.lit(head), F.replace(term, F.lit(" "), F.lit("%20")), F.lit(tail))


def hash_unit(key: Column, seed: int) -> Column:
    """A number in [0, 1) fixed by key and seed, on any engine and partitioning."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
