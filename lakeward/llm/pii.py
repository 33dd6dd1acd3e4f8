"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base rules find the plain forms. Besides, several high-recall generators a kind propose
overlapping spans (spelled-out addresses, numbers with other separators, phone numbers
without a plus, other forms of IP addresses, access keys); boosted trees score each by its format
and the text around it, and thresholds calibrated per kind pick those to redact. The
trees are fitted on generated, labelled sentences and become one Column expression,
so documents never leave the JVM.
"""

from __future__ import annotations

import random
from functools import lru_cache, reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

KINDS = ("email", "ip", "card", "phone")

# The base forms. Runs are possessive and entered at their start only, which changes no match
# and keeps long runs linear; \G lets a match begin where the last one ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: What only candidates can be, besides KINDS.
PROPOSED_KINDS = (*KINDS, "secret")
LOCAL, LABEL = r"(?<![a-z0-9._%+-])[a-z0-9._%+-]++", r"[a-z0-9-]++"
AT, DOT = r"(?: ?[(\[{]at[)\]}] ?| at | ?@ ?)", r" ?[(\[{]dot[)\]}] ?| dot "
SPELLED = r"(?i)@|[(\[{]at[)\]}]| at [a-z0-9-]+(?: ?[(\[{]dot| dot | ?\.)"
DIGIT = "0123456789"
NAMES = r"token|secret|password|passwd|pwd|api[_ -]?key|access[_ -]?key|auth"

#: The generators by kind: a pattern, one that every text with a match also has, so that the
#: others are not searched, and what is looked for even before that: DIGIT or some literals. Those of
#: one kind overlap; the trees tell which span is right.
PROPOSED = {
    "email": (
        (rf"(?i){LOCAL}{AT}{LABEL}(?:(?:{DOT}|\.){LABEL})+", SPELLED, ()),
        (rf"(?i){LOCAL}{AT}{LABEL}(?:(?:{DOT}| ?\. ?){LABEL})+", SPELLED, ()),
    ),
    "ip": (
        (r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])", ":", (":",)),
        (r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}(?![0-9A-Za-z:])", "::", ("::",)),
        (r"(?i)(?<![0-9])[0-9]{1,3}(?:(?: ?[(\[{](?:dot|\.)[)\]}] ?| dot )[0-9]{1,3}){3}(?![0-9])", r"(?i)[0-9] ?(?:[(\[{](?:dot|\.)|dot )", DIGIT),
    ),
    "card": (
        (r"(?<![0-9])[0-9]{4}([ ./-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])", "[0-9]{4}[ ./-][0-9]{4}", DIGIT),
        (r"(?<![0-9])[0-9]{4}([ ./-])[0-9]{6}\1[0-9]{5}(?![0-9])", "[0-9]{4}[ ./-][0-9]{6}", DIGIT),
        (r"(?<![0-9])[0-9](?:[ ./-]?[0-9]){12,18}(?![0-9])", "[0-9][ ./-]?[0-9][ ./-]?[0-9][ ./-]?[0-9]", DIGIT),
    ),
    "phone": (
        (r"(?<![0-9+(.-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-]?[0-9]{3,4}(?![.-]?[0-9])", "[0-9]{2}", DIGIT),
        (r"(?<![0-9+])00[ .-]?[1-9][0-9]{0,2}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])", "00[ .-]?[1-9]", DIGIT),
        (r"(?<![0-9+])0[1-9][0-9]{0,3}[ /-][0-9]{3,4}(?:[ -]?[0-9]{2,4}){1,2}(?![0-9])", "0[1-9][0-9]*[ /-]", DIGIT),
    ),
    "secret": (
        (rf"(?i)(?<=(?:{NAMES})[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?)[A-Za-z0-9_+/=.-]{{12,}}+", rf"(?i)(?:{NAMES})[\"']?\s{{0,3}}[=:]", ("=", ":")),
        (r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Za-z0-9]{32,}+", "[A-Za-z0-9]{32}", DIGIT),
        (r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}+)(?![A-Za-z0-9])", "AKIA|gh[pousr]_", ("AKIA", "gh")),
    ),
}

#: Characters before a candidate in which a hint may stand.
CONTEXT = 32
HINTS = {
    "email": r"(?i)mail|contact|write|reach",
    "ip": r"(?i)\bip\b|host|address|server|login",
    "card": r"(?i)card|visa|credit|payment|debit|\bcc\b",
    "phone": r"(?i)phone|\btel|call|mobile|\bcell|fax|whatsapp",
    "secret": rf"(?i)(?:{NAMES})[\"']?\s{{0,3}}[=:]",
}
AGAINST = r"(?i)order|invoice|serial|version|isbn|ticket|\bref|\bid\b|batch|part no|\bsha|commit|digest|checksum|md5"
FEATURES = ("digits", "marks", "length", "luhn", "left", "right", "hint", "against", "lead", "groups", "odd", "broken", "signs")

TREES, DEPTH, RATE = 24, 3, 0.3
#: Share of true spans among those a threshold picks, on the rows it is calibrated with.
PRECISION = 0.98


def bind(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(n: Column, values: Column, block: int = 256) -> Column:
    """Sums of values[0:i] for i in 0..n-1; blocks keep the work near linear."""
    zero = F.lit(0).cast("int")
    total = lambda a: F.aggregate(a, zero, lambda s, x: s + x)

    def starts(v: Column) -> Column:
        blocks = F.transform(F.sequence(zero, F.floor((n - 1) / block).cast("int")), lambda k: total(F.slice(v, k * block + 1, F.lit(block))))
        return F.aggregate(
            blocks,
            F.struct(zero.alias("at"), F.array().cast("array<int>").alias("all")),
            lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")),
        )["all"]

    def sums(z: Column) -> Column:
        at = lambda i: F.element_at(z["b"], F.floor(i / block).cast("int") + 1) + total(F.slice(z["v"], i - i % block + 1, i % block))
        return F.transform(F.sequence(zero, n - 1), at)

    return bind(values, lambda v: bind(F.struct(v.alias("v"), starts(v).alias("b")), sums))


EMPTY = "array<struct<s:int,e:int,x:string,before:string,after:string>>"


def matches(text: Column, pattern: str, needs: str, first: Column | None = None) -> Column:
    """All matches; `needs` is a pattern that a text with a match cannot lack, nor does `first` fail on it."""
    some = text.rlike(needs) if first is None else first & text.rlike(needs)
    return F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def located(text: Column, found: Column, pattern: str) -> Column:
    """Matches with start and end in code points and the characters around them: the pieces
    between them tell, so no text is counted through once a match."""
    n = F.size(found)

    def spans(p: Column) -> Column:
        starts = prefix_sums(n, F.zip_with(p, found, lambda a, m: F.length(a) + F.length(m)))
        begin = F.zip_with(starts, F.slice(p, F.lit(1), n), lambda a, b: a + F.length(b))
        tail = F.transform(found, lambda m: F.right(m, F.lit(CONTEXT)))
        before = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.right(F.concat(F.when(i > 0, F.get(tail, i - 1)).otherwise(F.lit("")), F.right(F.get(p, i), F.lit(CONTEXT))), F.lit(CONTEXT)))
        after = F.transform(F.sequence(F.lit(1), n), lambda i: F.left(F.concat(F.left(F.get(p, i), F.lit(1)), F.when(i < n, F.left(F.get(found, i), F.lit(1))).otherwise(F.lit(""))), F.lit(1)))
        whole = F.arrays_zip(begin.alias("s"), found.alias("x"), before.alias("before"), after.alias("after"))
        return F.transform(whole, lambda z: F.struct(z["s"].alias("s"), (z["s"] + F.length(z["x"])).alias("e"), z["x"].alias("x"), z["before"].alias("before"), z["after"].alias("after")))

    return F.when(n > 0, bind(F.split(text, pattern, -1), spans)).otherwise(F.array().cast(EMPTY))


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def holds(kind: str, x: Column) -> Column:
    """Whether a base match stands."""
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return x.rlike(rf"^{part}(?:\.{part}){{3}}$")
    n = F.length(digits(x))
    if kind == "card":
        return n.between(16, 19) & luhn(x)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def luhn(x: Column) -> Column:
    return F.call_function("luhn_check", digits(x))


def features(kind: str, span: Column) -> Column:
    """What the trees see of a candidate."""
    x, before = span["x"], span["before"]
    side = lambda c: F.when(c == "", 0).when(c.rlike(r"[\s,;:.!?()\"']"), 1).when(c.rlike("[A-Za-z]"), 2).when(c.rlike("[0-9]"), 3).otherwise(4)
    n = F.length(digits(x))
    values = {
        "digits": n,
        "marks": F.length(F.regexp_replace(x, "[A-Za-z0-9]", "")),
        "length": F.length(x),
        "luhn": F.when(n.between(13, 19) & luhn(x), 1).otherwise(0) if kind == "card" else F.lit(0),
        "left": side(F.right(before, F.lit(1))),
        "right": side(span["after"]),
        "hint": before.rlike(HINTS[kind]).cast("int"),
        "against": before.rlike(AGAINST).cast("int"),
        "lead": F.when(x.rlike("^[(0]"), 1).when(x.rlike("^[3-6]"), 2).otherwise(0),
        "groups": F.size(F.split(x, "[^0-9A-Za-z]+", -1)),
        "odd": x.rlike(r"(?i)[(\[{](?:at|dot)| at .* dot ").cast("int"),
        "broken": x.rlike(r"[.] | [.]").cast("int"),
        "signs": F.size(F.array_distinct(F.split(F.regexp_replace(x, "[0-9A-Za-z]", ""), ""))),
    }
    return F.struct(span["s"].alias("s"), span["e"].alias("e"), span["x"].alias("x"), *(values[f].cast("int").alias(f) for f in FEATURES))


def _standing(kind: str):
    return lambda s: holds(kind, s["x"])


def _described(kind: str):
    return lambda s: features(kind, s)


#: What a text with a base match has.
BASE_NEEDS = {
    "email": ("@[A-Za-z0-9-]", ("@",)), "ip": (r"[0-9]\.[0-9]", DIGIT), "card": ("[0-9][0-9 -]{14}", DIGIT), "phone": (r"\+[0-9]", ("+",)),
}


def candidates(docs: DataFrame) -> DataFrame:
    """Adds t (whole text), per kind of KINDS the base spans b_, and per kind the proposed
    spans with features c_; spans that several generators propose are one."""
    t = F.col("t")
    rows = docs.withColumn("t", F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = rows.withColumn("digit", t.rlike("[0-9]"))
    sets = {f"b_{k}": [(BASE[k], *BASE_NEEDS[k])] for k in KINDS} | {f"c_{k}": [*PROPOSED[k]] for k in PROPOSED_KINDS}
    each = [(f"{name}_{i}", *x) for name, some in sets.items() for i, x in enumerate(some)]

    def first(literals: str | tuple[str, ...]) -> Column | None:
        if literals == DIGIT:
            return F.col("digit")
        return reduce(or_, (t.contains(x) for x in literals)) if literals else None

    rows = rows.select("*", *(matches(t, pattern, needs, first(literals)).alias(f"r_{name}") for name, pattern, needs, literals in each))
    rows = rows.select("*", *(located(t, F.col(f"r_{name}"), pattern).alias(f"l_{name}") for name, pattern, _, _ in each))
    joined = lambda name: F.concat(*(F.col(f"l_{name}_{i}") for i in range(len(sets[name]))))
    return rows.select(
        "*",
        *(F.filter(joined(f"b_{k}"), _standing(k)).alias(f"b_{k}") for k in KINDS),
        *(F.transform(F.array_distinct(joined(f"c_{k}")), _described(k)).alias(f"c_{k}") for k in PROPOSED_KINDS),
    )


# -- the trees


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> tuple:
    """A regression tree on gradients: (feature, threshold, below, above) or a leaf value."""
    leaf = float(-g.sum() / (h.sum() + 1.0))
    if depth == 0 or len(g) < 10:
        return (leaf,)
    best, gain = None, 1e-3
    base = g.sum() ** 2 / (h.sum() + 1)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[1:]:
            low = x[:, f] < cut
            a, b = g[low].sum() ** 2 / (h[low].sum() + 1), g[~low].sum() ** 2 / (h[~low].sum() + 1)
            if a + b - base > gain:
                best, gain = (f, float(cut), low), a + b - base
    if best is None:
        return (leaf,)
    f, cut, low = best
    return (f, cut, grow(x[low], g[low], h[low], depth - 1), grow(x[~low], g[~low], h[~low], depth - 1))


def leaf_of(tree: tuple, row: np.ndarray) -> float:
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] < tree[1] else tree[3]
    return tree[0]


def boost(x: np.ndarray, y: np.ndarray) -> list[tuple]:
    trees, margin = [], np.zeros(len(y))
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(x, p - y, p * (1 - p), DEPTH)
        trees.append(tree)
        margin += RATE * np.array([leaf_of(tree, r) for r in x])
    return trees


def margin_of(trees: list[tuple], x: np.ndarray) -> np.ndarray:
    return np.array([RATE * sum(leaf_of(t, r) for t in trees) for r in x])


def expression(tree: tuple) -> str:
    """SQL of a tree on the fields of a span `s`."""
    if len(tree) == 1:
        return f"{tree[0]!r}D"
    return f"CASE WHEN s.{FEATURES[tree[0]]} < {tree[1]:g} THEN {expression(tree[2])} ELSE {expression(tree[3])} END"


# -- what they are fitted on


def examples(seed: int = 5, n: int = 2400) -> list[tuple[int, str, str, str]]:
    """Generated sentences (row, text, kind, the span that is personal data or '')."""
    r = random.Random(seed)
    words = "the of and to in is that it for on was with as be by an at this from or".split()
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    name = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(3, 9)))
    some = lambda: " ".join(r.choice(words) if r.random() < 0.6 else name() for _ in range(r.randint(4, 10)))
    mixed = lambda k: "".join(r.choice("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(k))
    hexed = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))

    def checked(k: int) -> str:
        body = r.choice("3456") + num(k - 2)
        total = sum(int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(body)))
        return body + str(-total % 10)

    def unchecked(k: int) -> str:
        x = checked(k)
        return x[:-1] + str((int(x[-1]) + r.randint(1, 9)) % 10)

    def split(x: str, by: str) -> str:
        return by.join(x[i : i + 4] for i in range(0, len(x), 4))

    out = []
    for i in range(n):
        kind, label = r.choice(PROPOSED_KINDS), r.randint(0, 1)
        lead, tail = "", ""
        if kind == "email":
            if label:
                at, dot = r.choice([("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), ("@", "[dot]"), ("@", " {dot} "), ("(at)", ".")])
                x = f"{r.choice(['', name() + '.', name() + '_'])}{name()}{at}{name()}{dot}{r.choice(['com', 'org', 'net'])}"
                lead, tail = r.choice(["", "mail", "contact"]), r.choice(["", ".", ","])
            else:
                x = r.choice([f"{name()} at {name()}. {name()} (dot) ", f"{name()} at {name()}.{name()} a dot of {name()}", f"look at {name()}. a dot on {name()}", f"{name()} at {name()}.{r.choice(['com', 'org'])}"])
        elif kind == "ip":
            if label:
                part = lambda: format(r.randrange(1 << 16), "x")
                x = r.choice([":".join(part() for _ in range(8)), f"{part()}:{part()}::{part()}:{part()}", r.choice(["[.]", "(.)", " dot ", "[dot]"]).join(str(r.randrange(256)) for _ in range(4))])
                lead = r.choice(["", "host", "ip"])
            else:
                x = r.choice([":".join(f"{r.randrange(60):02d}" for _ in range(8)), " dot ".join(num(3) for _ in range(4)).replace("0", "9"), f"{r.randrange(24):02d}::{r.randrange(60):02d}"])
                lead = r.choice(["", "id", "serial"])
        elif kind == "card":
            k = r.choice([13, 14, 15, 16, 16, 16, 19])
            if label:
                lead = r.choice(["", "card", "visa", "credit"]) if r.random() < 0.8 else ""
                x = checked(k)
                x = f"{x[:4]}{(by := r.choice(' -'))}{x[4:10]}{by}{x[10:]}" if k == 15 and r.random() < 0.5 else split(x, r.choice(["", ".", "/", "-"]))
            else:
                lead = r.choice(["order", "invoice", "serial"]) if r.random() < 0.7 else ""
                x = split(unchecked(k) if r.random() < 0.9 else checked(k), r.choice(["", "", ".", "/"])) if r.random() < 0.7 else f"{num(4)}/{num(4)}/{num(4)}/{num(3)}"
                lead = lead or (r.choice(["order", "invoice"]) if r.random() < 0.5 else "")
        elif kind == "phone":
            if label:
                x = r.choice([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"0{r.randint(11, 99)} {num(4)} {num(4)}", f"{num(3)}.{num(3)}.{num(4)}", f"00{r.choice(['44', '49', '33'])} {num(3)} {num(4)} {num(2)}", f"0{r.randint(111, 999)}/{num(4)} {num(2)}"])
                lead = r.choice(["phone", "tel", "call", "mobile", ""])
            else:
                x = r.choice([f"19{num(2)} {num(4)}", f"{num(4)}-{num(4)}", f"{num(2)}.{num(3)}.{num(3)}", f"{num(4)} {num(3)} {num(3)}", f"007{num(3)} {num(4)}"])
                lead = r.choice(["", "order", "version", "isbn", "part no"])
        elif label:
            x = r.choice([hexed(40), hexed(32), mixed(40), mixed(r.randint(16, 48))])
            sign = r.choice(['"', "", "'"])
            lead, tail = f"{r.choice(['token', 'api_key', 'secret', 'password', 'TOKEN', 'access key'])}{r.choice([' = ', '=', ': '])}{sign}", sign
        else:
            x = r.choice([hexed(40), hexed(64), name() * 5, hexed(32), mixed(36)])
            lead = r.choice(["commit ", "sha1 ", "digest ", "md5: ", "", "id "])
        joint = "" if lead and kind == "secret" else " "
        out.append((i, f"{some()} {lead}{joint if lead else ''}{x}{tail} {some()}", kind, x if label else ""))
    return out


@lru_cache(maxsize=1)
def model() -> dict[str, tuple[list[tuple], float]]:
    """Per kind the trees and the threshold on their sum. A candidate is right if it is the
    sentence's span to the letter. Half of the sentences grow the trees, half set the lowest
    threshold that reaches PRECISION."""
    spark = SparkSession.getActiveSession()
    rows = spark.createDataFrame(examples(), "row int, text string, kind string, truth string").coalesce(2)
    found = candidates(rows).select("row", "kind", "truth", *(f"c_{k}" for k in PROPOSED_KINDS)).collect()
    out = {}
    for kind in PROPOSED_KINDS:
        x, y, part = [], [], []
        for r in found:
            for c in r[f"c_{kind}"] if r.kind == kind else ():
                x.append([c[f] for f in FEATURES])
                y.append(c["x"] == r.truth)
                part.append(r.row % 2)
        x, y, part = np.array(x, float).reshape(-1, len(FEATURES)), np.array(y, float), np.array(part)
        trees = boost(x[part == 0], y[part == 0])
        margin, truth = margin_of(trees, x[part == 1]), y[part == 1]
        levels = np.unique(margin)
        good = [k for k, c in enumerate(levels) if truth[margin >= c].mean() >= PRECISION]
        # between two levels, so that no rounding of a sum decides
        out[kind] = (trees, float((levels[good[0]] + levels[good[0] - 1]) / 2 if good[0] else levels[0] - 1) if good else 1e9)
    return out


#: Spans that one step of the sweep holds.
SWEEP = 256


def swept(base: Column, scored: Column) -> Column:
    """Of scored spans (s, e, p, k) those that no other span, base or scored, covers; of equal ones a base
    span stands before scored ones and the higher score before the lower. So whatever passed its
    threshold lies within a span that stands. Sorted by start, longer ones first, a span is covered
    if an earlier one ends no sooner; steps of bounded size keep the work near linear."""
    as_row = lambda x, late, p, k: F.struct(x["s"].alias("s"), (-x["e"]).alias("back"), F.lit(late).alias("late"), (-p).alias("worse"), k.alias("k"))
    line = F.array_sort(F.concat(F.transform(base, lambda b: as_row(b, 0, F.lit(0.0), F.lit(0))), F.transform(scored, lambda c: as_row(c, 1, c["p"], c["k"]))))
    none = F.array().cast("array<struct<s:int,e:int,p:double,k:int>>")

    def step(a: Column, x: Column) -> Column:
        own = F.struct(x["s"].alias("s"), (-x["back"]).alias("e"), (-x["worse"]).alias("p"), x["k"].alias("k"))
        stands = (x["late"] == 1) & (-x["back"] > a["wall"])
        return F.struct(F.when(stands, F.array_append(a["out"], own)).otherwise(a["out"]).alias("out"), F.greatest(a["wall"], -x["back"]).alias("wall"))

    def block(a: Column, xs: Column) -> Column:
        return bind(F.aggregate(xs, F.struct(none.alias("out"), a["wall"].alias("wall")), step), lambda z: F.struct(F.concat(a["out"], z["out"]).alias("out"), z["wall"].alias("wall")))

    def run(sorted_: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(sorted_) - 1) / SWEEP).cast("int")), lambda i: F.slice(sorted_, i * SWEEP + 1, F.lit(SWEEP)))
        return F.aggregate(blocks, F.struct(none.alias("out"), F.lit(0).alias("wall")), block, lambda a: a["out"])

    return F.when(F.size(scored) > 0, bind(line, run)).otherwise(none)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret,
    secret_spans, cuts, text); spans are of KINDS, secrets such as access keys stand apart, cuts
    are all of them as (start, end) in order, those that overlap or touch as one.

    Null and empty texts have no spans (the digest of the empty string); repeated rows and
    null ids are rows like any other; an added span stands unless another span covers it, so
    added ones may overlap; an empty table gives an empty result;
    columns of docs other than doc_id and text are dropped. Whole texts are read, however
    long; work per text is near linear in its length and its number of spans.
    """
    fitted = model()
    rows = candidates(docs.select("doc_id", "text"))
    scored = []
    for i, k in enumerate(PROPOSED_KINDS):
        trees, cut = fitted[k]
        total = " + ".join(f"{RATE} * {expression(t)}" for t in trees)
        picked = F.expr(f"filter(transform(c_{k}, s -> struct(s.s as s, s.e as e, cast({total} as double) as p, {i} as k)), s -> s.p >= {cut!r}D)")
        scored.append(F.when(F.size(f"c_{k}") > 0, picked).otherwise(F.array().cast("array<struct<s:int,e:int,p:double,k:int>>")))
    ends = lambda a: F.transform(a, lambda s: F.struct(s["s"].alias("s"), s["e"].alias("e")))
    rows = rows.withColumn("all_base", F.concat(*(ends(f"b_{k}") for k in KINDS))).withColumn("maybe", F.concat(*scored))
    rows = rows.withColumn("added", swept(F.col("all_base"), F.col("maybe")))
    told = lambda k, a: F.transform(a, lambda s: F.concat(F.lit(f"{k}:"), s["s"], F.lit(":"), s["e"]))
    own = lambda i: ends(F.filter("added", lambda s: s["k"] == i))
    both = lambda i, k: F.array_sort(F.concat(ends(f"b_{k}"), own(i)))
    return rows.select(
        "doc_id",
        *(F.size(f"b_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(F.concat(*(told(k, F.col(f"b_{k}")) for k in KINDS)), ","), 256).alias("base_sha256"),
        F.array_join(F.concat(*(told(k, both(i, k)) for i, k in enumerate(KINDS))), ",").alias("spans"),
        F.size(own(len(KINDS))).cast("bigint").alias("n_secret"),
        F.array_join(told("secret", own(len(KINDS))), ",").alias("secret_spans"),
        cut_out(F.array_sort(F.concat("all_base", ends("added")))).alias("cuts"),
        F.col("text"),
    )


def merged(cuts: Column) -> Column:
    """Sorted spans (s, e), those that overlap or touch as one."""
    kind = "struct<s:int,e:int>"
    none, nothing = F.array().cast(f"array<{kind}>"), F.lit(None).cast(kind)

    def step(a: Column, x: Column) -> Column:
        meets = F.coalesce(x["s"] <= a["last"]["e"], F.lit(False))
        one = F.struct(a["last"]["s"].alias("s"), F.greatest(a["last"]["e"], x["e"]).alias("e"))
        return F.struct(F.when(meets | a["last"].isNull(), a["out"]).otherwise(F.array_append(a["out"], a["last"])).alias("out"), F.when(meets, one).otherwise(x).alias("last"))

    def block(a: Column, xs: Column) -> Column:
        return bind(F.aggregate(xs, F.struct(none.alias("out"), a["last"].alias("last")), step), lambda z: F.struct(F.concat(a["out"], z["out"]).alias("out"), z["last"].alias("last")))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(cuts) - 1) / SWEEP).cast("int")), lambda i: F.slice(cuts, i * SWEEP + 1, F.lit(SWEEP)))
    return F.aggregate(blocks, F.struct(none.alias("out"), nothing.alias("last")), block, lambda a: F.array_append(a["out"], a["last"]))


def cut_out(spans: Column) -> Column:
    """Sorted spans, merged if there are any."""
    return F.when(F.size(spans) > 0, merged(spans)).otherwise(spans)


def without_spans(text: Column, cuts: Column, mark: str) -> Column:
    """The text with each of the merged cuts replaced. What is kept is cut out in regions of
    SWEEP pieces, so no piece is counted from the text's start."""

    def run(m: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(m, lambda x: x["e"]))
        ends = F.concat(F.transform(m, lambda x: x["s"]), F.array(F.length(text)))
        kept = F.arrays_zip(starts.alias("s"), ends.alias("e"))
        regions = F.transform(F.sequence(F.lit(0), F.floor(F.size(m) / SWEEP).cast("int")), lambda i: F.slice(kept, i * SWEEP + 1, F.lit(SWEEP)))

        def pieces(r: Column) -> Column:
            at = F.get(r, 0)["s"]
            region = F.substring(text, at + 1, F.element_at(r, -1)["e"] - at)
            return bind(F.struct(region.alias("t"), at.alias("at")), lambda z: F.transform(r, lambda x: F.substring(z["t"], x["s"] - z["at"] + 1, x["e"] - x["s"])))

        return F.array_join(F.flatten(F.transform(regions, pieces)), mark)

    return bind(cuts, run)


def redact(docs: DataFrame, mark: str = "[REDACTED]") -> DataFrame:
    """`docs` with every span replaced by `mark`, secrets included; spans that overlap or touch
    become one. Null texts stay null; every row and column is kept, whatever the columns'
    names; repeated rows are redacted alike; an empty table gives an empty result."""
    columns = docs.columns
    packed = docs.select(F.struct(*columns).alias("doc_id"), F.col("text"))
    got = find_personal_data(packed)
    whole = F.coalesce(F.col("text").cast("string"), F.lit(""))
    clean = F.when(F.size("cuts") > 0, without_spans(whole, F.col("cuts"), mark)).otherwise(F.col("text"))
    return got.select("doc_id.*", clean.alias("__clean")).select(*(F.col("__clean").alias("text") if c == "text" else F.col(c) for c in columns))


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents")).drop("cuts", "text")
