"""Forwarded mails cut into segments, people turned into tokens.

Marks of a mail (header keys, rulers, ITEM lines, model lines) are found in one pass over
its text and folded once, so the work grows with the text alone. Names are found by one
automaton per mail.
"""

from __future__ import annotations

import datetime as dt
import re
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomline.functions import text as tx

# Functions of this module run in Python workers: they travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Header keys; those whose last value ends with its line; model numbers; rulers; dates of ITEM lines.
KEYS = ("From", "Sent", "To", "Cc", "Bcc", "Subject", "When", "Where")
LINE_KEYS = ("From", "Sent", "Subject", "Where")
MODEL = r"[BMT]\d{3}[A-Z]{3}\d{2}\.[A-Z0-9]+"
RULER = r"-{3,}\s*Original (?:Message|Appointment)\s*-{3,}"
ITEM = r"(?i:ITEM)[ \t]*:?"
ITEM_DATE = r"(?:(\d{4})[/年])?(\d{1,2})[/月](\d{1,2})日?"
ITEM_LINES = 3
YEAR_SLACK_DAYS = 7

_ANY = "|".join(KEYS)
# '**Key:**' anywhere, or 'Key:' at the start of a line; rulers, ITEM and model numbers only there.
_MARK = re.compile(rf"\*\*({_ANY}):\*\*[ \t]*|^[ \t]*(?:({_ANY}):[ \t]*|(?P<ruler>{RULER})[ \t]*$|(?P<item>{ITEM})[ \t]*$|(?P<model>{MODEL}))", re.M)
_BLANK_LINE = re.compile(r"\n[ \t]*\n")
_AFTER_ITEM = re.compile(r"\n*((?:[^\n]*\n?){1,%d})" % ITEM_LINES)
_ITEM_DATE = re.compile(ITEM_DATE)
_SPACE = re.compile(r"[\s ]+")

FIELDS = T.StructType([T.StructField(k.lower(), T.StringType()) for k in KEYS])
BLOCK = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()), T.StructField("fields", FIELDS)])
FACTS = T.StructType([T.StructField("has_headers", T.BooleanType()), T.StructField("when", T.StringType()), T.StructField("where", T.StringType())])
SEGMENT = T.StructType([
    T.StructField("segment_no", T.IntegerType()), T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("raw", T.StringType()),
    T.StructField("body", T.StringType()), T.StructField("has_header", T.BooleanType()), T.StructField("fields", FIELDS), T.StructField("item_date", T.DateType())])


class Marks:
    """What one pass over a mail finds."""

    def __init__(self, text: str):
        self.text = text
        self.keys: list[tuple[int, int, str]] = []
        self.rulers: list[tuple[int, int]] = []
        self.items: list[tuple[int, int]] = []
        self.models: list[int] = []
        for m in _MARK.finditer(text):
            if m[1] or m[2]:
                self.keys.append((m.start(), m.end(), m[1] or m[2]))
            elif m["ruler"]:
                self.rulers.append((m.start(), m.end()))
            elif m["item"]:
                self.items.append((m.start(), m.end()))
            else:
                self.models.append(m.start())

    def value(self, k: int, group_only: bool = True) -> tuple[str, int]:
        """Value of the k-th key and where it ends: at the next key, else at the line or the first blank line."""
        _, begin, name = self.keys[k]
        limit = self.keys[k + 1][0] if k + 1 < len(self.keys) else len(self.text)
        last = k + 1 == len(self.keys) or self.keys[k + 1][2] == "From" or not group_only
        stop = limit
        if last and name in LINE_KEYS:
            line = self.text.find("\n", begin, limit)
            stop = limit if line < 0 else line
        elif last:
            blank = _BLANK_LINE.search(self.text, begin, limit)
            stop = blank.start() if blank else limit
        return _SPACE.sub(" ", self.text[begin:stop]).strip(), stop

    def blocks(self) -> list[dict]:
        """Header blocks: a From and the keys up to the next one, with a Sent or a Subject among them."""
        made: list[dict] = []
        for k, (start, _, name) in enumerate(self.keys):
            if name == "From":
                made.append({"start": start, "fields": {}})
            if made:
                value, made[-1]["stop"] = self.value(k)
                made[-1]["fields"].setdefault(name.lower(), value)
        return [b for b in made if "sent" in b["fields"] or "subject" in b["fields"]]

    def first_value(self, name: str) -> str | None:
        """First value of a key anywhere in the text."""
        return next((self.value(k, False)[0] or None for k, key in enumerate(self.keys) if key[2] == name), None)

    def starts(self, blocks: list[dict]) -> list[int]:
        """Where the blocks' segments start: at their line, or at the ruler right above it."""
        made, line, ruler = [], 0, -1
        for b in blocks:
            line = max(line, self.text.rfind("\n", line, b["start"]) + 1)
            while ruler + 1 < len(self.rulers) and self.rulers[ruler + 1][1] <= line:
                ruler += 1
            above = ruler >= 0 and not self.text[self.rulers[ruler][1]:line].strip()
            made.append(self.rulers[ruler][0] if above else line)
        return made

    def item_dates(self, mail_date: dt.date | None) -> list[tuple[int, dt.date]]:
        """Places of ITEM lines and the date that follows; without a year that of the mail, or the year before if that lies ahead."""
        made = []
        for start, stop in self.items:
            found = _ITEM_DATE.search(_AFTER_ITEM.match(self.text, stop)[1])
            year = found and (int(found[1]) if found[1] else mail_date.year if mail_date else None)
            if not year:
                continue
            try:
                day = dt.date(year, int(found[2]), int(found[3]))
                if not found[1] and (day - mail_date).days > YEAR_SLACK_DAYS:
                    day = day.replace(year=year - 1)
            except ValueError:
                continue
            made.append((start, day))
        return made

    def segments(self, mail_date: dt.date | None) -> list[dict]:
        """Segments in document order: by header blocks, else by model lines, else the whole; number 0 is what stands before."""
        if not self.text.strip():
            return []
        blocks = self.blocks()
        starts = self.starts(blocks) if blocks else self.models
        kind = "thread" if blocks else "minutes" if starts else "whole"
        dates = [] if blocks else self.item_dates(mail_date)
        numbered = list(enumerate(starts, 1))
        if not starts or starts[0] > 0:
            numbered.insert(0, (0, 0))
        made, seen = [], 0
        for (no, start), (_, stop) in zip(numbered, [*numbered[1:], (None, len(self.text))]):
            block = blocks[no - 1] if blocks and no else None
            while seen < len(dates) and dates[seen][0] < start:
                seen += 1
            raw = self.text[start:stop]
            made.append({"segment_no": no, "kind": kind, "start": start, "raw": raw, "body": self.text[block["stop"]:stop] if block else raw,
                         "has_header": block is not None, "fields": block["fields"] if block else None, "item_date": dates[seen - 1][1] if seen else None})
        return made


def _filled(fields: dict | None) -> dict:
    return {k.lower(): (fields or {}).get(k.lower()) for k in KEYS}


@F.pandas_udf(T.ArrayType(BLOCK))
def _header_blocks(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: [b | {"fields": _filled(b["fields"])} for b in Marks(t).blocks()] if t else [])


def header_blocks(text: Column) -> Column:
    """Array of (start, stop, fields) of the header blocks; a From without Sent and Subject is plain text."""
    return _header_blocks(F.when(F.contains(text, F.lit("From:")), text))


@F.pandas_udf(FACTS)
def _mail_facts(texts: pd.Series) -> pd.DataFrame:
    marks = [Marks(t or "") for t in texts]
    return pd.DataFrame({"has_headers": [bool(m.blocks()) for m in marks], "when": [m.first_value("When") for m in marks], "where": [m.first_value("Where") for m in marks]})


def mail_facts(text: Column) -> Column:
    """(has_headers, when, where): the last two are the first values anywhere in the text."""
    return _mail_facts(F.when(F.contains(text, F.lit("From:")) | F.contains(text, F.lit("When:")) | F.contains(text, F.lit("Where:")), text))


@F.pandas_udf(T.ArrayType(SEGMENT))
def mail_segments(texts: pd.Series, dates: pd.Series) -> pd.Series:
    """Segments of a mail with its date."""
    return pd.Series([[s | {"fields": _filled(s["fields"])} for s in Marks(t or "").segments(d if isinstance(d, dt.date) else None)] for t, d in zip(texts, dates)])


def by_line_marker(text: Column, marker: str) -> Column:
    """Text cut at the start of every line that opens with ``marker``."""
    return F.filter(F.split(text, rf"(?m)(?=^[ \t]*(?:{marker}))"), lambda p: p != "")


def content_kind(text: Column, has_header: Column, has_when: Column, attachments: Column, models: Column,
                 has_item: Column) -> Column:
    """Kind of a segment by its signals and length."""
    n = F.length(text)
    minutes = text.rlike(r"(?i)meeting minutes|會議紀錄|會議記錄|紀要|纪要")
    attach = text.rlike(r"(?i)see attached|as attached|attached file|如附件|請參考附件|附件|file server|please refer the attached")
    return (
        F.when(has_item | (models >= 3) | (minutes & (n >= tx.MINUTES_CHARS)), F.lit("inline_minutes"))
        .when(has_header & (n >= tx.SHORT_TEXT_CHARS), F.lit("thread_reply"))
        .when(has_header & has_when & (n < tx.SHORT_TEXT_CHARS), F.lit("appointment"))
        .when((n < tx.SHORT_TEXT_CHARS) & ((attachments > 0) | attach), F.lit("attachment_only"))
        .when(n < tx.MIN_BODY_CHARS, F.lit("noise"))
        .when(has_header, F.lit("thread_reply"))
        .when(models >= 1, F.lit("inline_minutes"))
        .otherwise(F.lit("noise"))
    )


_FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# Least characters of a name to look for: shorter ones hit common words.
LEAST_ASCII, LEAST_OTHER = 3, 2


class NameBook:
    """Names of one mail in an automaton, so that a text is read once however many there are."""

    def __init__(self, entries):
        import ahocorasick

        self.finder = ahocorasick.Automaton()
        self.tokens: dict[str, str] = {}
        forms: dict[str, list[str]] = {}
        for name, token in sorted(entries, key=lambda e: (-len(e[0]), e[0])):
            if name not in forms.setdefault(name.translate(_FOLD), []):
                forms[name.translate(_FOLD)].append(name)
            self.tokens[name.translate(_FOLD)] = token
        for folded, names in forms.items():
            self.finder.add_word(folded, names)
        if forms:
            self.finder.make_automaton()
        self.empty = not forms

    @staticmethod
    def _counts(text: str, start: int, stop: int, name: str) -> bool:
        """ASCII names need other neighbours than letters and digits; their case counts unless they have several parts."""
        if not name.isascii():
            return text[start:stop] == name
        if any(c.isascii() and c.isalnum() for c in (text[start - 1:start] + text[stop:stop + 1])):
            return False
        return any(c in name for c in " ,@") or text[start:stop] == name

    def hits(self, text: str) -> list[tuple[int, int]]:
        """Places of names, leftmost first, the longest where several start."""
        if self.empty or not text:
            return []
        found = []
        for last, names in self.finder.iter(text.translate(_FOLD)):
            start = last + 1 - len(names[0])
            if any(self._counts(text, start, last + 1, n) for n in names):
                found.append((start, last + 1))
        found.sort(key=lambda h: (h[0], -h[1]))
        kept, free = [], 0
        for start, stop in found:
            if start >= free:
                kept.append((start, stop))
                free = stop
        return kept

    def masked(self, text: str) -> str:
        out, at = [], 0
        for start, stop in self.hits(text):
            out += [text[at:start], self.tokens[text[start:stop].translate(_FOLD)]]
            at = stop
        return "".join([*out, text[at:]])


def _books(entries: pd.Series):
    """The book of each row; rows of the same mail share one."""
    made: dict[tuple, NameBook] = {}
    for row in entries:
        key = tuple((e["name"], e["token"]) for e in (row if row is not None else ()))
        if key not in made:
            made[key] = NameBook(key)
        yield made[key]


@F.pandas_udf(T.StringType())
def _masked_names(texts: pd.Series, entries: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else b.masked(t) for t, b in zip(texts, _books(entries))], dtype=object)


@F.pandas_udf(T.IntegerType())
def _names_left(texts: pd.Series, entries: pd.Series) -> pd.Series:
    return pd.Series([len(b.hits(t or "")) for t, b in zip(texts, _books(entries))])


def _long_enough(entries: Column) -> Column:
    """Numbers and addresses of any length; names of two characters, of three in ASCII."""
    least = lambda e: F.when(e["name"].rlike(r"^\p{ASCII}+$"), F.lit(LEAST_ASCII)).otherwise(F.lit(LEAST_OTHER))
    return F.filter(entries, lambda e: F.length(e["name"]) >= least(e))


def mask_dictionary(text: Column, entries: Column) -> Column:
    """Names of an array<struct<name, token>> replaced by their tokens in one pass.

    Longest names first; ASCII names need non-alphanumeric neighbours, and single
    words keep their case so that common words stay.
    """
    return _masked_names(text, _long_enough(entries))


def names_left(text: Column, entries: Column) -> Column:
    """Names of the dictionary still to be found in a text: the gate after masking, 0 if all went."""
    return _names_left(text, _long_enough(entries))


def fold_first_names(text: Column, firsts: Column) -> Column:
    """'Alex <P01>' to '<P01>' for the first names of that token's person (array<struct<first, token>>), never a name alone."""
    quoted = F.transform(firsts, lambda e: F.concat(F.lit(r"\Q"), e["first"], F.lit(r"\E\s+(?="), e["token"], F.lit(")")))
    pattern = F.concat(F.lit("(?<![A-Za-z0-9])(?:"), F.array_join(quoted, "|"), F.lit(")"))
    return F.when(F.size(firsts) > 0, F.regexp_replace(text, pattern, F.lit(""))).otherwise(text)


def assign_tokens(entries: Column) -> Column:
    """Entries (key1, key2, kind) in order of appearance → their tokens.

    The first key already known gives the token; otherwise P01, P02 … for people and
    G01 … for groups. Later keys of the same entry join the same token.
    """
    state = F.struct(
        F.array().cast("array<string>").alias("tokens"), F.lit(0).alias("p"), F.lit(0).alias("g"),
        F.create_map().cast("map<string,string>").alias("known"))

    def step(s, e):
        known = F.coalesce(F.try_element_at(s["known"], e["key1"]), F.try_element_at(s["known"], e["key2"]))
        is_new, group = known.isNull(), e["kind"] == "group"
        n = F.when(group, s["g"]).otherwise(s["p"]) + 1
        fresh = F.concat(F.when(group, F.lit("G")).otherwise(F.lit("P")), F.format_string("%02d", n))
        token = F.coalesce(known, fresh)
        keys = F.filter(F.array_distinct(F.array(e["key1"], e["key2"])),
                        lambda k: k.isNotNull() & ~F.map_contains_key(s["known"], F.coalesce(k, F.lit(""))))
        return F.struct(
            F.concat(s["tokens"], F.array(token)).alias("tokens"),
            (s["p"] + (is_new & ~group).cast("int")).alias("p"), (s["g"] + (is_new & group).cast("int")).alias("g"),
            F.map_concat(s["known"], F.map_from_arrays(keys, F.transform(keys, lambda _: token))).alias("known"))

    return F.aggregate(entries, state, step, lambda s: s["tokens"])
