"""Several values packed in one field: infer the delimiters, split, explode with position."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_missing

# Candidate delimiters, the stronger first, as regular expressions.
DELIMITERS = {
    "newline": "\\r\\n|\\r|\\n", "tab": "\\t", "double bar": "\\|\\|", "bar": "\\|", "semicolon": "[;；]", "middle dot": "[·•‧・]", "wide comma": "[，、]", "spaced slash": " / ", "spaced plus": " \\+ ",
    "comma": ",", "slash": "/", "plus": "\\+", "hyphen": "-", "spaced hyphen": " [-–—] ", "ampersand": " & ", "conjunction": " (?:ve|and|und|et) ", "dot": "\\.", "blank": " ",
}
# What must stand in a value for a candidate to be in it; plain texts, which are found much faster than patterns.
SIGNS = {
    "newline": ["\n", "\r"], "tab": ["\t"], "double bar": ["||"], "bar": ["|"], "semicolon": [";", "；"], "middle dot": ["·", "•", "‧", "・"], "wide comma": ["，", "、"], "spaced slash": [" / "], "spaced plus": [" + "],
    "comma": [","], "slash": ["/"], "plus": ["+"], "hyphen": ["-"], "spaced hyphen": [" - ", " – ", " — "], "ampersand": [" & "], "conjunction": [" ve ", " and ", " und ", " et "], "dot": ["."], "blank": [" "],
}
# Legal endings that follow a comma inside one name.
LEGAL = "l\\.?p|l\\.?l\\.?c|l\\.?l\\.?p|inc|ltd|limited|gmbh|co|corp|plc|s\\.?a|s\\.?r\\.?l|b\\.?v|ag|a\\.?[sş]|a\\.?o|anonim şirketi|ltd\\. ?şti|llp|kg|jr|sr|ph\\.?d|mba"
TITLES = re.compile(r"^(?:(?:prof|doç|doc|dr|sn|mr|mrs|ms|bay|bayan|av|ing|dipl|yrd|hon)\.? ?)+$", re.I)
LEGAL_RE = re.compile(rf"^(?:{LEGAL})\.?$", re.I)
MARK = re.compile(r"^\s*(?:[-*•‣▪–—]\s+|\(?\d{1,2}[.)]\s+|\(?[a-hA-H]\)\s+)")
NUMBERED = re.compile(r"(?:^|[\s;,|])\(?(\d{1,2})[.)]\s+(?=\S)")
#: share of regular pieces from which a delimiter is one of a field's own; a lesser one is enough for those that are checked in each value again
REGULAR, CHECKED = 0.75, 0.5
#: delimiters that also stand inside names: each value is checked again before they split it
INSIDE = ("ampersand", "conjunction", "plus", "hyphen", "spaced hyphen", "dot", "blank")
LISTED = "[\\r\\n\\t|;；·•，、,]| / | \\+ "
#: spread of the piece counts, by their mean, beyond which a delimiter is no delimiter
SPREAD = 2.0


def score(values: DataFrame) -> DataFrame:
    """(field, delimiter, n_values, regular, mean_pieces, sd_pieces, least, own) over values(field, value); a field stands for a source.

    Delimiter-free values show what a whole item of the field looks like: `least` words at least (5th percentile; names
    have two, technologies one). A piece is regular if it has so many words and starts with a letter or digit; where
    one word makes an item, it must also stand alone as some delimiter-free value, once it is split at the other strong
    delimiters. Delimiters of INSIDE are looked for in what the strong ones leave together. After a comma, legal endings belong to what precedes them, and lone words that come in pairs are names written
    the other way round. regular is the share of regular pieces; sd_pieces tells how consistent the piece counts are.
    own: regular from REGULAR on (CHECKED for those of INSIDE) and sd_pieces / mean_pieces within SPREAD.
    """
    v = values.withColumn("v", F.trim(F.regexp_replace("value", "\"|\\([^)]*\\)|[\\[\\]]", "")))
    strong = LISTED + "| & | (?:ve|and|und|et) "
    single = v.filter(~F.col("v").rlike(strong) & (F.col("v") != ""))
    words = single.groupBy("field").agg(F.percentile_approx(F.size(F.split("v", " +")), 0.05).alias("least"))
    clean = lambda x: F.trim(F.regexp_replace(x, "^\\s*(?:[-*•] |\\(?\\d+[.)] )|\\s+$", ""))
    none = F.array().cast("array<string>")
    fused = F.regexp_replace("v", f"(?i), ?(?=(?:{LEGAL})\\.?(?:$|[,;|&]| (?:ve|and|und|et) ))", " ")
    split = lambda c, p: F.filter(F.transform(F.split(c, p), clean), lambda x: x != "")
    within = lambda p: F.flatten(F.filter(F.transform(F.split("v", LISTED), lambda c: F.when(c.rlike(p), split(c, p)).otherwise(none)), lambda x: F.size(x) > 1))
    there = lambda n: reduce(lambda a, b: a | b, (F.contains(F.col("v"), F.lit(t)) for t in SIGNS[n]))
    cut = lambda n, p: F.when(there(n), within(p) if n in INSIDE else split(fused if n == "comma" else F.col("v"), p)).otherwise(none)
    cands = F.array(*(F.struct(F.lit(n).alias("delimiter"), cut(n, p).alias("pieces")) for n, p in DELIMITERS.items()))
    # the words table has one row per field
    x = v.join(F.broadcast(words), "field").select("field", "least", F.explode(cands).alias("c")).filter(F.size("c.pieces") > 1).select("field", "least", "c.*")
    size = lambda y: F.size(F.split(y, " +"))
    begins = lambda y: y.rlike("^[\\p{L}\\p{N}]")
    lone = F.size(F.filter("pieces", lambda y: (size(y) == 1) & begins(y)))
    paired = (F.col("delimiter") == "comma") & (lone % 2 == 0)
    fine = F.when(F.col("least") > 1, F.size(F.filter("pieces", lambda y: begins(y) & ((size(y) >= F.col("least")) | paired & (size(y) == 1)))))
    n = F.size("pieces")
    counts = x.groupBy("field", "delimiter").agg(F.count("*").alias("n_values"), F.avg(n).alias("mean_pieces"), F.coalesce(F.stddev(n), F.lit(0.0)).alias("sd_pieces"), F.max("least").alias("words"), (F.sum(fine) / F.sum(n)).alias("long"))
    # where one word makes an item: each distinct piece once, with its frequency, against the values that stand alone
    whole = single.join(F.broadcast(words.filter("least = 1")), "field", "left_semi").select("field", F.col("v").alias("piece")).distinct().withColumn("there", F.lit(1))
    short = x.filter("least = 1").select("field", "delimiter", F.explode("pieces").alias("y")).groupBy("field", "delimiter", "y").agg(F.count("*").alias("n"))
    short = short.select("field", "delimiter", "n", F.explode(F.split("y", strong)).alias("piece")).withColumn("piece", clean(F.col("piece"))).filter("piece <> ''")
    short = short.join(whole.hint("merge"), ["field", "piece"], "left").groupBy("field", "delimiter").agg((F.sum(F.when(F.col("there").isNotNull() & begins(F.col("piece")), F.col("n")).otherwise(0)) / F.sum("n")).alias("regular"))
    # one row per field and delimiter
    out = counts.join(F.broadcast(short), ["field", "delimiter"], "left").withColumn("regular", F.coalesce("long", "regular", F.lit(0.0)))
    enough = F.when(F.col("delimiter").isin(*INSIDE), CHECKED).otherwise(REGULAR)
    own = (F.col("regular") >= enough) & (F.col("sd_pieces") <= SPREAD * F.col("mean_pieces"))
    return out.select("field", "delimiter", "n_values", "regular", "mean_pieces", "sd_pieces", F.col("words").alias("least"), own.alias("own"))


#: stand-ins of protected pieces: the private-use planes
HELD = re.compile("[\U000f0000-\U0010ffff]")
MOST_HELD = 0x1FFFF


def _protect(text: str, seps: re.Pattern) -> tuple[str, list[str]]:
    """Quoted pieces and brackets, and private-use characters that the text itself holds, as one private-use character each."""
    kept: list[str] = []

    def keep(s: str) -> str:
        kept.append(s)
        return chr(0xF0000 + len(kept) - 1)

    if text.count('"') + text.count("(") + len(HELD.findall(text)) > MOST_HELD:
        return text, [chr(0xF0000 + k) for k in range(MOST_HELD + 1)]  # more than there are stand-ins: nothing is protected
    out, i, start = [], 0, True
    while i < len(text):
        c = text[i]
        if HELD.match(c):
            out.append(keep(c))
            i, start = i + 1, False
            continue
        if c == "(" and (j := text.find(")", i)) > 0:
            out.append(keep(text[i : j + 1]))
            i, start = j + 1, False
            continue
        if c == '"' and start:
            j = i + 1
            while j < len(text):
                if text[j] == '"':
                    if text[j + 1 : j + 2] == '"':
                        j += 2
                        continue
                    rest = text[j + 1 :].lstrip(" ")
                    if not rest or seps.match(text[j + 1 :]) or seps.match(" " + rest) or seps.match(rest):
                        break
                j += 1
            if j < len(text):
                out.append(keep(text[i + 1 : j].replace('""', '"')))
                i, start = j + 1, False
                continue
        out.append(c)
        start = start and c == " " or bool(seps.fullmatch(c))
        if not start and c == " ":
            start = bool(re.search(r"(?: & | (?:ve|and|und|et) | / | \+ )$", "".join(out[-5:])))
        i += 1
    return "".join(out), kept


def _words(piece: str) -> int:
    return len([w for w in piece.split() if not HELD.fullmatch(w) and not TITLES.match(w)])


def split_value(text: str, own: set[str], least: int) -> list[str]:
    """The items of one value, in written order. own: the delimiters inferred for its field; least: words of a whole item.

    Nothing is split but at these. An item is never less than whole: a comma before a legal ending, between a lone surname and its given name, and an
    ampersand after a lone word join their neighbours instead of parting them.
    """
    t = text.strip()
    if t[:1] == "[" and t[-1:] == "]":
        for loads in (json.loads, lambda s: json.loads(re.sub(r"(?<=[\[,\s])'|'(?=\s*[,\]])", '"', s))):
            try:
                got = loads(t)
                return [s for s in (str(x).strip() for x in got if x is not None) if s] if isinstance(got, list) else [t]
            except ValueError:
                continue
        t = t[1:-1].strip()
    if "&" in t and ";" in t:
        t = html.unescape(t)
    hard = [d for d in ("newline", "tab", "double bar", "bar", "semicolon", "middle dot", "wide comma", "spaced slash", "spaced plus", "slash") if d in own]
    seps = re.compile("|".join(DELIMITERS[d] for d in [*hard, "ampersand", "conjunction", "comma"]))
    body, kept = _protect(t, seps)
    back = lambda s: HELD.sub(lambda m: kept[ord(m[0]) - 0xF0000], s)
    if MARK.match(t) and not re.match(r"\s*\(?[a-hA-H]\)", t):
        body, kept = t, []
        marks = [m for m in NUMBERED.finditer(t)]
        if len(marks) > 1 and [int(m[1]) for m in marks] == list(range(1, len(marks) + 1)):
            ends = [m.start() for m in marks[1:]] + [len(t)]
            return [s for s in (t[m.end() : e].strip().strip(";,|").strip() for m, e in zip(marks, ends, strict=True)) if s]
        lines = [MARK.sub("", s).strip() for s in re.split(DELIMITERS["newline"], t)]
        if len(lines) > 1:
            return [s.strip('"') for s in lines if s]
    pieces = [body]
    if hard:
        pieces = re.split("|".join(DELIMITERS[d] for d in hard), body)
    out: list[str] = []
    for piece in pieces:
        out += [q for p in _soft(piece.strip(" ,"), own, least) for q in _inside(p, own, least)]
    return [s for s in (MARK.sub("", back(p)).strip() if len(p) > 1 else back(p).strip() for p in out) if s and s not in ('"', "-")]


def _inside(piece: str, own: set[str], least: int) -> list[str]:
    """Split at an inferred delimiter that may also stand inside a name, if all that comes out is whole."""
    for d in ("spaced hyphen", "plus", "hyphen", "dot", "blank"):
        if d in own:
            got = [s.strip() for s in re.split(DELIMITERS[d], piece)]
            if len(got) > 1 and all(_words(s) >= least for s in got):
                return [q for s in got for q in _inside(s, own - {d}, least)]
    return [piece]


def _soft(piece: str, own: set[str], least: int) -> list[str]:
    parts: list[str] = []
    for p in (x.strip() for x in (piece.split(",") if "comma" in own else [piece])):
        if not p:
            continue
        lead = re.match(r"(?:&|ve|and|und|et) (?=\S)", p)
        if lead and parts:
            p = p[lead.end() :].strip()
        ending = re.match(rf"({LEGAL})(\.?) (?:&|ve|and|und|et) (?=\S)", p, re.I)
        if ending and parts:
            parts[-1] += ", " + ending[1] + ending[2]
            p = p[ending.end() :].strip()
        alone = least > 1 and len(p) > 1 and _words(p) == 1 and not re.search(r"[-]", p.replace(" ", "")[:1])
        if parts and LEGAL_RE.match(p):
            parts[-1] += ", " + p
        elif parts and least > 1 and "," not in parts[-1] and _words(parts[-1]) == 1 and len(parts[-1]) > 1 and (_words(p) <= 1 or " " in p and not alone and _conj_head(p)):
            parts[-1] += ", " + p
        else:
            parts.append(p)
    out: list[str] = []
    for p in parts:
        out += _conjoined(p, own, least)
    return out


def _conj_head(p: str) -> bool:
    """The text up to the first conjunction is one given name."""
    head = re.split(r" (?:&|ve|and|und|et) ", p)
    return len(head) > 1 and _words(head[0]) == 1


def _conjoined(p: str, own: set[str], least: int) -> list[str]:
    between = [w for d, w in (("ampersand", "&"), ("conjunction", "ve|and|und|et")) if d in own]
    if not between:
        return [p] if p.strip() else []
    bits = re.split(f" ({'|'.join(between)}) ", p)
    out, i = [bits[0]], 1
    while i < len(bits):
        word, nxt = bits[i], bits[i + 1]
        whole = lambda s: least <= 1 or _words(s) >= least or len(s.strip()) == 1 or "," in s
        if whole(out[-1]) and (whole(nxt) or i + 2 < len(bits)):
            out.append(nxt)
        else:
            out[-1] += f" {word} {nxt}"
        i += 2
    return [s.strip() for s in out if s.strip()]


def items(values: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """(field, row_id, pos, item): one row per item of values(field, row_id, value); pos counts from 1 in written order.

    Missing values (null, blank, stand-ins) give no rows; a value with one item gives one row; empty places are
    skipped and repeats stay. The inferred delimiters of each field (a table of a few dozen rows) go with the tasks.
    """
    v = values.filter(~is_missing(F.col("value")))
    rows = score(v.select("field", "value")).select("field", "delimiter", "own", "least").collect()
    own: dict[str, set[str]] = {}
    least: dict[str, int] = {}
    for r in rows:
        own.setdefault(r.field, set())
        if r.own:
            own[r.field].add(r.delimiter)
        least[r.field] = r.least

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            p["items"] = [split_value(t, own.get(f, set()), least.get(f, 1)) for f, t in zip(p["field"], p["value"], strict=True)]
            yield p[["field", "row_id", "items"]]

    lists = v.select("field", F.col("row_id").cast("bigint").alias("row_id"), "value").mapInPandas(run, "field string, row_id bigint, items array<string>")
    return lists.select("field", "row_id", F.size("items").alias("n"), F.posexplode("items").alias("pos", "item")).withColumn("pos", F.col("pos") + 1)


def unpivoted(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """values(field, row_id, value) of several columns, in one pass over the rows."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields))
    return df.select(F.col(key).alias("row_id"), F.explode(pairs).alias("x")).select("x.field", "row_id", "x.value")


__all__ = ["DELIMITERS", "items", "score", "split_value", "unpivoted"]
