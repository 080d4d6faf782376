"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides.

A text is scanned once for candidates of each kind. Five labelers vote for, against or not at all: the strict form,
a check of the value (Luhn sum, ranges, digits), a gazetteer of endings, prefixes and codes, the words before the
span, and its edges. Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler
is for each kind, and a logistic classifier on votes and shape is fitted to the posteriors. Patterns are few by
construction (kinds x 3^5 x shapes), so only their counts reach the driver; spans stay on the executors.

Spans of the strict form that pass their check are always kept; the classifier adds further candidates.

Defined cases. NULL text counts as empty. Texts without candidates give empty lists. Rows that repeat are each
returned. Without any candidate in the corpus nothing is learned and nothing added. Offsets are code points, the end
exclusive. Further columns are not looked at; ``redact`` keeps the text outside the spans as it is.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import stored, strings

KINDS = ("email", "ip", "card", "phone", "secret")
ACCEPT = 0.8

# Fixed values of the query contract: the strict forms.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Wider forms that only the votes can confirm.
NUMERIC = re.compile(r"[+0-9][0-9 ().+-]*")  # every number-like match lies inside one of these zones
LOCAL_PHONE = re.compile(r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])")
SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]+(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?)[A-Za-z0-9-]+)+")
SECRET = re.compile(r"(?i)(?:password|passwd|secret|token|api[_-]?key)[ \t]*[=:][ \t]*([^\s,;\"']{6,})")
SECRET_WORDS = ("password", "passwd", "secret", "token", "key")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")  # EMAIL behind its at sign
IP_AT_EDGE = re.compile(r"(?<![0-9])" + IP.pattern)  # a match of IP begins where its digits begin

# Gazetteers.
ENDINGS = frozenset("com org net edu gov info biz io de fr es uk eu us".split())
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65")
CALLING_CODES = ("1", "33", "34", "39", "44", "49", "61", "81", "86", "91")
BEFORE = {
    "email": frozenset("mail email e-mail contact write".split()),
    "ip": frozenset("ip host server address".split()),
    "card": frozenset("card visa mastercard credit payment".split()),
    "phone": frozenset("phone tel telephone call mobile fax".split()),
    "secret": frozenset("login user credentials".split()),
}
AGAINST = frozenset("version page chapter isbn order invoice section figure build".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def valid(kind: str, value: str) -> bool:
    """The check of a strict match: parts of an address, Luhn sum, number of digits."""
    if kind == "ip":
        return all(int(x.lstrip("0")[:4] or 0) <= 255 for x in value.split("."))  # a part may have any number of digits
    if kind == "card":
        d = _digits(value)
        return 12 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(_digits(value)) <= 15
    return True


def _addresses(text: str):
    """Matches of EMAIL, looked for once at each at sign: what stands before it is one run, from the last match on."""
    at, done = text.find("@"), 0
    while at >= 0:
        low = at
        while low > done and text[low - 1] in LOCAL:
            low -= 1
        found = DOMAIN.match(text, at + 1) if low < at else None
        if found:
            done = found.end()
            yield low, done
        at = text.find("@", max(at + 1, done))


def candidates(text: str) -> list[tuple[int, str, int, bool]]:
    """(start, kind, end, strict) of all candidates; strict ones form the base."""
    out = [(s, "email", e, True) for s, e in _addresses(text)]
    for zone in NUMERIC.finditer(text):
        run, at = zone.group(), zone.start()
        if len(run) < 7:
            continue
        for kind, form in (("ip", IP_AT_EDGE), ("card", CARD), ("phone", PHONE)):
            for m in form.finditer(run):
                if valid(kind, m.group()):
                    out.append((at + m.start(), kind, at + m.end(), True))
                elif kind != "card" or 12 <= len(_digits(m.group())) <= 19:
                    out.append((at + m.start(), kind, at + m.end(), False))
        low = at - (at > 0 and text[at - 1] == "(")
        for m in LOCAL_PHONE.finditer(text[low:at + len(run)]):
            out.append((low + m.start(), "phone", low + m.end(), False))
    if "(at)" in text or "[at]" in text or "(AT)" in text or "[AT]" in text:
        out += [(m.start(), "email", m.end(), False) for m in SPELLED.finditer(text)]
    folded = text.lower()
    if any(w in folded for w in SECRET_WORDS):
        out += [(m.start(1), "secret", m.end(1), False) for m in SECRET.finditer(text)]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def votes(text: str, start: int, kind: str, end: int, strict: bool) -> tuple[int, ...]:
    """For (1), against (-1) or no vote (0) of each labeler."""
    value = text[start:end]
    digits = _digits(value)
    form = 1 if strict else 0
    if kind == "secret":
        check = 1 if any(c.isdigit() for c in value) and any(c.isalpha() for c in value) else -1
    elif kind == "phone":
        check = 1 if 9 <= len(digits) <= 15 else -1
    else:
        check = 0 if kind == "email" else (1 if valid(kind, value) else -1)
    if kind == "email":
        listed = 1 if value.rsplit(".", 1)[-1].lower() in ENDINGS else 0
    elif kind == "card":
        listed = 1 if digits.startswith(ISSUERS) else -1
    elif kind == "phone":
        listed = (1 if digits.startswith(CALLING_CODES) else -1) if value[0] == "+" else 0
    elif kind == "ip":
        listed = -1 if digits[:1] == "0" else 0
    else:
        listed = -1 if value.lower() in ("changeme", "password", "example") else 0
    words = [w.strip(".,:;!?=()").lower() for w in text[max(0, start - 40):start].split()[-3:]]
    near = 1 if any(w in BEFORE[kind] for w in words) else -1 if any(w in AGAINST for w in words) else 0
    left, right = text[start - 1:start], text[end:end + 1]
    edges = -1 if left.isalnum() or right.isalnum() or left == "." else 1 if not left.strip() and (not right.strip() or right in ".,;:!?)") else 0
    return form, check, listed, near, edges


def _pattern(kind: str, given: tuple[int, ...], value: str) -> str:
    shape = f"{min(len(value) // 8, 3)}{int(any(c in ' -.()' for c in value))}"
    return f"{kind}|{''.join('-0+'[v + 1] for v in given)}|{shape}"


def label(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, found): found holds (start, kind number, end, strict, pattern) for each candidate of the text."""
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def one(text: str | None):
        text = text or ""
        return [
            {"start": s, "kind": KINDS.index(k), "end": e, "strict": strict, "pattern": _pattern(k, votes(text, s, k, e, strict), text[s:e])}
            for s, k, e, strict in candidates(text)
        ]

    def run(batches):
        for batch in batches:
            yield pd.DataFrame({"doc_id": strings(batch["doc_id"]), "found": [one(t) for t in strings(batch["text"])]})

    found = "array<struct<start:int,kind:int,end:int,strict:boolean,pattern:string>>"
    return rows.mapInPandas(run, f"doc_id string, found {found}")


def reliabilities(given: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, float, np.ndarray]:
    """EM for one kind: (posterior of each pattern, prior, table[class, labeler, vote]) from votes in -1, 0, 1.

    Starts from the vote of the majority. One is added to every cell, so a labeler that never votes stays neutral.
    """
    total = given.sum(axis=1)
    p = 1 / (1 + np.exp(-total.astype(float)))
    table, prior = np.zeros((2, given.shape[1], 3)), 0.5
    for _ in range(rounds):
        prior = (p @ counts + 1) / (counts.sum() + 2)
        for c, w in enumerate(((1 - p) * counts, p * counts)):
            for v in (-1, 0, 1):
                table[c, :, v + 1] = w @ (given == v) + 1
        table /= table.sum(axis=2, keepdims=True)
        logs = [np.log(table[c][np.arange(given.shape[1]), given + 1]).sum(axis=1) for c in (0, 1)]
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1] + np.log((1 - prior) / prior), -50, 50)))
        if np.abs(new - p).max() < 1e-6:
            break
        p = new
    return p, prior, table


def _features(patterns: list[str]) -> np.ndarray:
    """Kind, votes for and against by labeler, and shape, as 0 and 1, with a constant."""
    rows = []
    for pattern in patterns:
        kind, given, shape = pattern.split("|")
        rows.append([
            1.0, *(kind == k for k in KINDS), *(v == "+" for v in given), *(v == "-" for v in given),
            *(shape[0] == str(i) for i in range(4)), shape[1] == "1",
        ])
    return np.array(rows, float)


def fit_classifier(patterns: list[str], counts: np.ndarray) -> np.ndarray:
    """Probability of each pattern, by logistic regression (ridge, Newton steps) on the posteriors of EM."""
    given = np.array([["-0+".index(v) - 1 for v in p.split("|")[1]] for p in patterns])
    soft = np.zeros(len(patterns))
    for kind in KINDS:
        own = np.array([p.startswith(f"{kind}|") for p in patterns])
        if own.any():
            soft[own] = reliabilities(given[own], counts[own].astype(float))[0]
    x, w = _features(patterns), np.sqrt(counts.astype(float))  # so that one frequent pattern doesn't decide alone
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (p - soft)) + 0.1 * beta
        hess = (x * (w * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.1 * np.eye(len(beta))
        step = np.linalg.solve(hess, grad)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))


def find(docs: DataFrame, accept: float = ACCEPT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, base and spans, arrays of (start, kind, end) by start and kind."""
    labelled = stored(label(docs, id_col, text_col), "pii-candidates")
    seen = labelled.select(F.explode("found.pattern").alias("pattern")).groupBy("pattern").count().orderBy("pattern").collect()
    patterns = [r["pattern"] for r in seen]
    if patterns:
        p = fit_classifier(patterns, np.array([r["count"] for r in seen]))
        taken = [x for x, y in zip(patterns, p) if y >= accept]
    else:
        taken = []
    known = F.array(*[F.lit(x) for x in taken]) if taken else F.array().cast("array<string>")

    def span(x: Column) -> Column:
        return F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))

    strict = F.filter("found", lambda x: x["strict"])
    more = F.filter(
        "found",
        lambda x: ~x["strict"] & F.array_contains(known, x["pattern"])
        & ~F.exists("found", lambda b: b["strict"] & (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    return labelled.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.array_sort(F.transform(strict, span)).alias("base"),
        F.array_sort(F.transform(F.concat(strict, more), span)).alias("spans"),
    )


def written(spans: str) -> Column:
    """The spans as text: kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])))


def redact(docs: DataFrame, accept: float = ACCEPT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in brackets. Ids must be unique."""
    spans = find(docs, accept, id_col, text_col).select(F.col("doc_id").alias("_id"), "spans")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, own in zip(strings(text), spans):
            at, parts = 0, []
            for s in own if own is not None else ():
                if s["start"] >= at:
                    parts += [t[at:s["start"]], f"[{KINDS[s['kind']]}]"]
                    at = s["end"]
            out.append("".join([*parts, t[at:]]))
        return pd.Series(out)

    joined = rows.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return joined.select("doc_id", cut("text", "spans").alias("text"))
