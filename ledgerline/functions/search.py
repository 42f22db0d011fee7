"""Word search, agency and vendor matching.

The rules for vendors and agencies are requirements told in prose; they run over distinct names, never over rows.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_PREFIX = 3  # letters of a last word that may end inside a name's word
LONG_WORD = 5  # letters from which any word may be a prefix


def plain_name(c: Column) -> Column:
    """Lower case, `&` as and, letters and digits only."""
    return F.trim(F.regexp_replace(F.replace(F.lower(c), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def agency_matches(name: Column, typed: str, aliases: dict[str, list[str]] | None = None) -> Column:
    """Every typed word is part of the plain name; else the typed text is an alias of it. The name wins."""
    words = re.sub("[^a-z0-9]+", " ", typed.lower().replace("&", " and ")).split()
    plain = plain_name(name)
    by_name = reduce(lambda a, b: a & b, [F.contains(plain, F.lit(w)) for w in words], F.lit(bool(words)))
    known = (aliases or {}).get(" ".join(words), [])
    return by_name | (name.isin(known) if known else F.lit(False))


def vendor_matches(name: Column, typed: str) -> Column:
    """Whether a vendor name fits what was typed.

    1. The name contains it (trimmed, lower case).
    2. Its letters and digits run through the name's, from a word's start to a word's end; of two words and more the end
       may lie inside a word if the last typed word has three letters.
    3. Of two words and more (one with three letters at least), each finds its own word of the name; the last may be a
       prefix from three letters on, any other from five.
    """
    query = typed.strip().lower()
    words = re.findall("[a-z0-9]+", query)
    if not query:
        return F.lit(True)
    low = F.lower(name)
    rules = [F.contains(low, F.lit(query))]
    own = F.regexp_extract_all(low, F.lit("[a-z0-9]+"), F.lit(0))
    if words:
        run = "".join(words)
        # The name's words with a mark before each: a run may step over marks, but starts at one.
        spelled = F.concat(F.lit("|"), F.array_join(own, "|"), F.lit("|"))
        pattern = r"\|" + r"\|?".join(re.escape(c) for c in run)
        open_end = len(words) >= 2 and len(words[-1]) >= LEAST_PREFIX
        rules.append(spelled.rlike(pattern if open_end else pattern + r"\|"))
    if len(words) >= 2 and max(map(len, words)) >= LEAST_PREFIX:
        rules.append(_distinct_words(own, words))
    return reduce(lambda a, b: a | b, rules)


def _distinct_words(own: Column, words: list[str]) -> Column:
    """Each typed word takes a word of the name that no other takes: exact ones first, then prefixes."""
    left = own
    ok = F.lit(True)
    loose = [(k, w) for k, w in enumerate(words) if len(w) >= (LEAST_PREFIX if k == len(words) - 1 else LONG_WORD)]
    for w in [w for k, w in enumerate(words) if (k, w) not in loose]:
        at = F.array_position(left, F.lit(w)).cast("int")
        ok &= at > 0
        left = F.when(at > 0, F.concat(F.slice(left, F.lit(1), F.greatest(at - 1, F.lit(0))), F.slice(left, at + 1, F.greatest(F.size(left), F.lit(1))))).otherwise(left)
    # The longest typed words first: their candidates are a subset of what a shorter prefix would take.
    for _, w in sorted(loose, key=lambda x: -len(x[1])):
        exact = F.array_position(left, F.lit(w)).cast("int")
        prefix = F.array_position(F.transform(left, lambda x: F.startswith(x, F.lit(w))), True).cast("int")
        at = F.when(exact > 0, exact).otherwise(prefix)
        ok &= at > 0
        left = F.when(at > 0, F.concat(F.slice(left, F.lit(1), F.greatest(at - 1, F.lit(0))), F.slice(left, at + 1, F.greatest(F.size(left), F.lit(1))))).otherwise(left)
    return ok


def highlighted(text: Column, typed: str) -> Column:
    """The text as HTML with what was typed in <mark>: its letters in one run over signs and blanks, else its words."""
    words = sorted(set(re.findall("[a-z0-9]+", typed.lower())), key=lambda w: (-len(w), w))
    if not words:
        return _escaped(text)
    run = "[^a-zA-Z0-9]*".join("".join(re.findall("[a-z0-9]+", typed.lower())))
    marked = F.regexp_replace(text, rf"(?i)(?<![a-z0-9])({run}|{'|'.join(words)})", "\u0001$1\u0002")
    return F.replace(F.replace(_escaped(marked), F.lit("\u0001"), F.lit("<mark>")), F.lit("\u0002"), F.lit("</mark>"))


def _escaped(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def lookup(index: DataFrame, exact: list[str], prefixes: list[str] | None = None) -> DataFrame:
    """Row ids that hold every word, and for each prefix some word that begins with it. index: (word, row_id).

    Terms are a few literals: a word range prunes the sorted index, and one aggregation intersects.
    """
    terms = [(f"={w}", F.col("word") == w) for w in dict.fromkeys(exact)] + [(f"^{p}", F.startswith("word", F.lit(p))) for p in dict.fromkeys(prefixes or [])]
    if not terms:
        return index.select("row_id").distinct()
    some = reduce(lambda a, b: a | b, [t for _, t in terms])
    hits = [F.max(t).alias(f"_{k}") for k, (_, t) in enumerate(terms)]
    return index.where(some).groupBy("row_id").agg(*hits).where(reduce(lambda a, b: a & b, [F.col(f"_{k}") for k in range(len(terms))])).select("row_id")


def is_verbatim(description: Column, text: Column) -> Column:
    """Whether the description's words stand in the text in this order."""
    words = F.filter(F.split(description, r"(?U)\s+"), lambda w: w != "")
    step = lambda rest, w: F.when(rest.isNull() | (F.instr(rest, w) == 0), F.lit(None)).otherwise(F.substr(rest, F.instr(rest, w) + F.length(w)))
    return F.aggregate(words, F.coalesce(text, F.lit("")), step).isNotNull()


def right_of_label(boxes: DataFrame, label: list[str], page: str = "page", band: float = 3.0) -> DataFrame:
    """page, value: the words right of a label, in order, whose middle lies within `band` of the label's middle.

    boxes: page, text, x0, x1, top, bottom of each word. The label is a run of words of one line; of several the first counts.
    """
    middle = (F.col("top") + F.col("bottom")) / 2
    words = boxes.select(page, F.struct(F.round(middle, 1).alias("y"), "x0", "x1", F.col("text").alias("w")).alias("b")).groupBy(page).agg(F.sort_array(F.collect_list("b")).alias("bs"))
    wanted = F.array(*[F.lit(w.lower()) for w in label])
    n = len(label)
    at = F.filter(F.sequence(F.lit(1), F.greatest(F.size("bs") - n + 1, F.lit(1))), lambda k: F.transform(F.slice("bs", k, F.lit(n)), lambda b: F.lower(b["w"])) == wanted)
    found = words.withColumn("last", F.get("bs", F.get(at, F.lit(0)) + n - 2)).where("last is not null")
    right = F.filter("bs", lambda b: (b["x0"] >= F.col("last.x1")) & (F.abs(b["y"] - F.col("last.y")) <= band))
    in_order = F.array_sort(F.transform(right, lambda b: F.struct(b["x0"].alias("x"), b["w"].alias("w"))))
    return found.select(page, F.array_join(F.transform(in_order, lambda b: b["w"]), " ").alias("value"))


def same_geometry(a: Column, b: Column, least: int = 40) -> Column:
    """Equal after flattening, or one begins with the other's first 40 characters."""
    x, y = (F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " ")) for c in (a, b))
    near = F.startswith(x, F.left(y, F.lit(least))) | F.startswith(y, F.left(x, F.lit(least)))
    return (x == y) | ((x != "") & (y != "") & near)
