"""Personal data by weak supervision.

Exact patterns find e-mail addresses, IP addresses, card and phone numbers. Wider rules propose
more candidates by their shape: written-out addresses, account numbers, identity numbers, streets,
other long numbers, keys and secrets, and names (words after a title, runs of capitalised words).
Labelers of three sorts (patterns, gazetteers, context) vote for or against each candidate or
abstain. For each kind, expectation-maximisation over the counts of vote patterns of all documents
estimates how reliable each labeler is, and its posteriors train a logistic classifier on span
features, which decides on the candidates. Exact matches stay in any case and train nothing.

Votes and features are small codes, so their patterns are few whatever the corpus: only their
counts are gathered, never candidates or documents.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import by_position
from .encode import text_slices
from .stopwords import ALL

BASE = ("email", "ip", "card", "phone")
ADDED = ("address", "iban", "ident", "street", "number", "secret", "name")
KINDS = BASE + ADDED

_AT = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number can only start where no digit stands before it: the same matches, found in one scan.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Leftmost matches: the local part is the whole run before an at sign, after the last match."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _AT.match(text, at + 1) if begin < at else None
        if m:
            out.append(("email", begin, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str) -> list[Span]:
    """The exact matches, by kind in the order of ``BASE``, then by start."""
    out = _emails(text)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# Words that stand before personal data, and before numbers or names that are none.
CUES = frozenset("phone tel telephone mobile cell fax call mail email e-mail contact address ssn iban account konto compte cuenta passport card token password passwd pwd key secret api apikey auth bearer login user name teléfono telefon téléphone dear signed regards sincerely named called born resident lives living adresse anschrift wohnhaft dirección domicilio domicilié ausweis pasaporte passeport dni nif".split())
NO_CUES = frozenset("page pages version isbn issn vol volume chapter section line figure table year art no nr paragraph build release size price usd eur order model part serial commit tracking the".split())
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Herr", "Frau", "Mme", "Monsieur", "Madame", "Señor", "Señora", "Sr", "Sra")
FIRST_NAMES = frozenset("james mary john anna peter paul maria michael thomas hans jürgen klaus sabine petra pierre jean marie claire luc josé juan carmen ana pedro luis laura sophie emma david sarah robert linda susan karen mark julia".split())
PROVIDERS = ("gmail", "yahoo", "hotmail", "outlook", "icloud", "proton", "gmx", "example", "mail")
PERSONAL = frozenset("said says wrote writes lives lived works worked born sagte sagt schrieb wohnt wohnte geboren dijo dice escribió vive nació dit écrit habite né née".split())
KEY_HEADS = ("sk-", "sk_", "pk_", "ghp_", "gho_", "xox", "AKIA", "AIza", "eyJ", "ssh-")
ID_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"

_DIGITS = re.compile(r"[0-9]+")
_WORDED = re.compile(r"(?<![\w.])[\w.+-]{1,64}\s?[\[(]?\s?(?:at|AT)\s?[\])]?\s?[\w-]{1,63}\s?[\[(]?\s?(?:dot|DOT)\s?[\])]?\s?[a-zA-Z]{2,24}\b")
_TITLED = re.compile(rf"\b(?:{'|'.join(TITLES)})\.?\s(?P<name>[A-ZÀ-ÞŒ][^\W\d_]+(?:\s[A-ZÀ-ÞŒ][^\W\d_]+)?)")
_CAPITAL = r"[A-ZÀ-ÞŒ][a-zß-ÿœ]+"
_CAPITALS = re.compile(rf"(?<![\w.'’-]){_CAPITAL}(?:-{_CAPITAL})?(?:\x20[A-Z]\.)?(?:\x20{_CAPITAL}(?:-{_CAPITAL})?)+(?![\w’'-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_IDENT = re.compile(r"(?<![\w.-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[A-Z]{1,2}[0-9]{6,9}|[0-9]{8}-?[A-Z])(?![\w-])")
_STREET = re.compile(
    rf"(?<!\w)(?:[0-9]{{1,5}}[a-z]?,?\x20(?:{_CAPITAL}\x20){{1,3}}(?:Street|St|Road|Rd|Avenue|Ave|Lane|Drive|Boulevard|Blvd|Court|Place|Way)"
    r"|[A-ZÄÖÜ][a-zäöüß-]{1,40}(?:straße|strasse|str\.|weg|platz|allee|gasse)\x20[0-9]{1,4}[a-z]?"
    rf"|[0-9]{{1,4}},?\x20(?:rue|avenue|boulevard|place|chemin)\x20(?:(?:de|du|des|la)\x20){{0,2}}{_CAPITAL}(?:\x20{_CAPITAL})?"
    rf"|(?:[Cc]alle|[Aa]venida|[Pp]laza|[Cc]amino)\x20(?:(?:de|del|la)\x20){{0,2}}{_CAPITAL}(?:\x20{_CAPITAL})?,?\x20[0-9]{{1,4}})(?!\w)")
_POSTCODE = re.compile(r",?\s[0-9]{4,5}\b|,?\s[A-ZÀ-Þ][a-zß-ÿ]+,?\s(?:[A-Z]{2}\s)?[0-9]{5}\b")
_KEY_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_+/=-")
_NUMBER = re.compile(r"[0-9](?:[\x20()./-]{0,2}[0-9]){5,}")
_KEY_RUN = re.compile(r"[A-Za-z0-9_+/=-]*")
_FORM = re.compile(r"[0-9a-f]{32,128}|[0-9]{3}-[0-9]{2}-[0-9]{4}|\(?[0-9]{3}\)?[ -][0-9]{3}-[0-9]{4}")


def _remainder_one(account: str) -> bool:
    moved = account.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in moved[4:] + moved[:4])) % 97 == 1


def _account(m: re.Match) -> Span:
    """The longest start of a match whose check digits hold, as capitals may follow; else all of it."""
    s = m.group()
    right = (k for k in range(len(s), 14, -1) if s[k - 1] != " " and not s[k : k + 1].isalnum() and _remainder_one(s[:k]))
    return "iban", m.start(), m.start() + next(right, len(s))


def candidates(text: str, taken: list[Span]) -> list[Span]:
    """Spans that may be personal data beside the exact ones, not overlapping them or each other."""
    out: list[Span] = []
    if "dot" in text or "DOT" in text:
        out += [("address", m.start(), m.end()) for m in _WORDED.finditer(text)]
    if any(t in text for t in TITLES):
        out += [("name", *m.span("name")) for m in _TITLED.finditer(text)]
    if digits := _DIGITS.search(text):
        out += [_account(m) for m in _IBAN.finditer(text)]
        out += [("ident", m.start(), m.end()) for m in _IDENT.finditer(text)]
        out += [("street", m.start(), m.end()) for m in _STREET.finditer(text)]
    out += [("name", m.start(), m.end()) for m in _CAPITALS.finditer(text)]
    done = 0
    for m in _DIGITS.finditer(text) if digits else ():
        if m.start() < done:
            continue
        begin, end = m.span()
        while begin > done and text[begin - 1] in _KEY_CHARS:
            begin -= 1
        end = _KEY_RUN.match(text, end).end()
        run = text[begin:end]
        done = end
        if len(run) >= 16 and sum(c.isdigit() for c in run) >= 3 and sum(c.isalpha() for c in run) >= 3:
            out.append(("secret", begin, end))
        elif n := _NUMBER.match(text, m.start()):
            done = max(done, n.end())
            if sum(c.isdigit() for c in n.group()) >= 7:
                out.append(("number", n.start(), n.end()))
    busy = sorted((a, b) for _, a, b in taken)
    starts = [a for a, _ in busy]
    reach = list(accumulate((b for _, b in busy), max))  # the furthest end of a span and all before it
    kept: list[Span] = []
    for kind, a, b in sorted(out, key=lambda s: (s[1], -s[2], ADDED.index(s[0]))):
        k = bisect_left(starts, b)  # spans that start before this one ends
        if (not kept or kept[-1][2] <= a) and (not k or reach[k - 1] <= a):
            kept.append((kind, a, b))
    return kept


_COMMON = frozenset(ALL)
_WORD = re.compile(r"[^\W\d_][\w-]*")
_TITLE_END = re.compile(rf"\b(?:{'|'.join(TITLES)})\.?\s\Z")
_LOW_WORD = re.compile(r"(?<!\w)[a-zß-ÿœ]+(?!\w)")


def low_words(text: str, spans: list[Span]) -> frozenset[str]:
    """Words that a text with name candidates also writes small."""
    return frozenset(_LOW_WORD.findall(text)) if any(k == "name" for k, _, _ in spans) else frozenset()


def _form(kind: str, s: str, text: str, a: int, b: int) -> str:
    """Votes by a form that only personal data have, or that they have not."""
    if kind == "name":
        return "1" if _TITLE_END.search(text, max(0, a - 12), a) else "0" if s.count(" ") > 2 else "-"
    if kind == "street":
        return "1" if _POSTCODE.match(text, b, b + 48) else "-"
    if kind == "secret" and s.startswith(KEY_HEADS):
        return "1"
    return "1" if _FORM.fullmatch(s) else "0" if kind == "number" else "-"


def _checked(kind: str, s: str) -> str:
    """Votes by check digits or letters."""
    if kind == "iban":
        return "1" if _remainder_one(s) else "0"
    if kind == "ident" and s[-1].isalpha():
        return "1" if ID_LETTERS[int(s[:8]) % 23] == s[-1] else "0"
    digits = "".join(c for c in s if c.isdigit())
    return "-" if kind != "number" or not 13 <= len(digits) <= 19 else "1" if _luhn(digits) else "0"


def _listed(kind: str, s: str, small: frozenset[str]) -> str:
    """Votes by lists: providers and first names; common words, and words written small elsewhere, speak against."""
    if kind == "address":
        return "1" if any(p in s.lower() for p in PROVIDERS) else "0" if s.lower().split()[0] in _COMMON else "-"
    if kind == "name":
        words = [w.lower() for w in _WORD.findall(s)]
        return "0" if any(w in _COMMON or w in small for w in words) else "1" if words[0] in FIRST_NAMES else "-"
    return "-"


def _variety(kind: str, s: str) -> str:
    """Votes by the variety of characters: bits of entropy a character for secrets."""
    if kind in ("name", "street"):
        return "-"
    bits = -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())
    if kind == "secret":
        return "1" if bits >= 3.3 else "0"
    return "0" if bits < 1.8 else "-"


def describe(text: str, span: Span, near: list[Span] = (), small: frozenset[str] = frozenset()) -> tuple[str, str]:
    """Votes (1 for, 0 against, - abstains) of the labelers, and the span's feature codes.

    ``near`` are the text's exact spans by start; ``small`` its words written small.
    """
    kind, a, b = span
    s = text[a:b]
    digits = sum(c.isdigit() for c in s)
    before = [w.lower() for w in _WORD.findall(text[max(0, a - 32) : a])][-3:]
    after = _WORD.match(text, b + 1, b + 32) if text[b : b + 1] in (" ", ",") else None
    lead = text[max(0, a - 3) : a].rstrip(" ")
    opens = not lead or lead[-1] in ".!?\n"
    cue, no_cue = bool(CUES & set(before)), bool(NO_CUES & set(before[-2:])) or lead[-1:] in ("$", "#", "§")
    assigned = lead.endswith(("=", ":", '"', "'", "<"))
    k = bisect_left(near, a, key=lambda x: x[1])
    close = k < len(near) and near[k][1] - b < 64 or k > 0 and a - near[k - 1][2] < 64
    votes = [
        _form(kind, s, text, a, b), _checked(kind, s), _listed(kind, s, small), _variety(kind, s),
        "1" if cue else "-",  # context: a cue before
        "0" if no_cue else "-",  # context: a cue that speaks against
        "1" if assigned else "-",  # context: assigned or quoted
        "1" if close else "-",  # context: an exact span nearby
        # context: what persons do follows; the large letter is that of a sentence
        "-" if kind != "name" else "1" if after and after.group() in PERSONAL else "0" if opens else "-",
    ]
    features = [
        str(8 if len(s) > 512 else min(7, len(s) // 6)), str(min(4, 5 * digits // max(1, len(s)))),
        str(int(cue)), str(int(no_cue)), str(int(assigned)), str(int(close)), str(min(3, len(set(s)) // 5)),
        *("-01".index(votes[j]) for j in (0, 1, 2, 3, 8))]
    return "".join(votes), "".join(map(str, features))


SIZES = (9, 5, 2, 2, 2, 2, 4, 3, 3, 3, 3, 3)
#: Votes for, against and abstentions that the truth and its opposite are taken to have brought before any was counted.
PRIOR = ((4.0, 1.0, 5.0), (1.0, 4.0, 5.0))


def estimate(patterns: dict[str, int], rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float, dict[str, float]]:
    """Each labeler's rates of voting for data and for other spans, the share of data, posteriors.

    Expectation-maximisation with labelers independent given the truth; abstaining is an answer
    too, so that a labeler that only ever votes for, or only against, tells something. It starts
    from the share of votes for. A vote never tells its opposite: where one kind of spans would
    bring more of it than the other should, both get the same rate.
    """
    keys = sorted(patterns)
    n = np.array([patterns[k] for k in keys], float)
    width = len(keys[0]) if keys else 0
    yes, no, none = (np.array([[c == x for c in k] for k in keys], float).reshape(len(keys), width) for x in "10-")
    p = (yes.sum(axis=1) + 0.25) / (yes.sum(axis=1) + no.sum(axis=1) + 1)
    true_rate = false_rate = np.zeros(width)
    share = 0.5
    for _ in range(rounds):
        w, v = n * p, n * (1 - p)
        true, false = (
            np.array([m @ x + q for x, q in zip((yes, no, none), prior)]) / (m.sum() + sum(prior)) for m, prior in zip((w, v), PRIOR))
        both = (n @ yes + 1) / (n.sum() + 2), (n @ no + 1) / (n.sum() + 2)
        for answer, wrong in ((0, true[0] < false[0]), (1, false[1] < true[1])):
            true[answer], false[answer] = (np.where(wrong, both[answer], x[answer]) for x in (true, false))
        true_rate, false_rate = true[0], false[0]
        share = (w.sum() + 1) / (n.sum() + 4)
        log = np.log(true / false)
        score = math.log(share / (1 - share)) + yes @ log[0] + no @ log[1] + none @ log[2]
        new = 1 / (1 + np.exp(-np.clip(score, -50, 50)))
        if len(new) == 0 or np.abs(new - p).max() < 1e-9:
            p = new
            break
        p = new
    return true_rate, false_rate, share, dict(zip(keys, p.tolist()))


def _one_hot(features: list[str]) -> np.ndarray:
    offsets = np.cumsum([0, *SIZES[:-1]])
    x = np.zeros((len(features), sum(SIZES) + 1))
    x[:, -1] = 1
    for i, f in enumerate(features):
        x[i, offsets + [int(c) for c in f]] = 1
    return x


def _expected() -> np.ndarray:
    """Weights before any candidate is seen: cues and votes for speak for a span, those against speak against."""
    w = np.zeros(sum(SIZES) + 1)
    offsets = np.cumsum([0, *SIZES[:-1]])
    for feature, weight in ((2, 1.5), (3, -1.5), (4, 1.0), (5, 0.5)):  # cue, cue against, assigned, close
        w[offsets[feature] + 1] = weight
    for feature in range(7, 12):  # votes: abstains, against, for
        w[offsets[feature] + 1 : offsets[feature] + 3] = -2, 2
    w[-1] = -2.5
    return w


def _fit(counts: dict[tuple[str, str], int], ridge: float) -> np.ndarray:
    """A logistic classifier of the posteriors, drawn towards the expected weights."""
    expected = _expected()
    if not counts:
        return expected
    votes: Counter = Counter()
    for (v, _), n in counts.items():
        votes[v] += n
    *_, posterior = estimate(votes)
    x = _one_hot([f for _, f in counts])
    n = np.array(list(counts.values()), float)
    y = np.array([posterior[v] for v, _ in counts])

    def loss(w):
        z = x @ w
        return n @ (np.logaddexp(0, z) - y * z) + ridge / 2 * ((w - expected) ** 2).sum()

    w = expected
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + ridge * (w - expected)
        hessian = (x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step, now = np.linalg.solve(hessian, gradient), loss(w)
        while np.abs(step).max() > 1e-8 and loss(w - step) > now:
            step = step / 2
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(counts: dict[tuple[str, str, str], int], ridge: float = 0.05) -> np.ndarray:
    """Weights of the span classifiers, a row for each added kind, from counts of (kind, votes, features).

    A kind without candidates has the weights expected; without any counts all are zero, which adds no span.
    """
    if not counts:
        return np.zeros((len(ADDED), sum(SIZES) + 1))
    return np.stack([_fit({(v, f): n for (x, v, f), n in counts.items() if x == kind}, ridge) for kind in ADDED])


def _described(text: str) -> tuple[list[Span], list[Span], list[tuple[str, str]]]:
    """Exact spans, candidates, and the candidates' votes and features."""
    base = base_spans(text)
    more = candidates(text, base)
    near, small = sorted(base, key=lambda s: s[1]), low_words(text, more)
    return base, more, [describe(text, s, near, small) for s in more]


def learn(docs: DataFrame) -> np.ndarray:
    """The classifiers' weights from all documents; zeros (nothing is added) without any candidate."""

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for _, _, texts in text_slices(batch.column(0)):
                for text in filter(None, texts):
                    _, more, told = _described(text)
                    held.update((kind, *x) for (kind, _, _), x in zip(more, told))
        kinds, votes, features = zip(*held) if held else ((), (), ())
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array(kinds, pa.string()), "votes": pa.array(votes, pa.string()), "features": pa.array(features, pa.string()),
            "n": pa.array(list(held.values()), pa.int64())})

    found = docs.select(F.col("text").cast("string")).mapInArrow(run, "kind string, votes string, features string, n long")
    key = ["kind", "votes", "features"]
    rows = found.groupBy(*key).agg(F.sum("n").alias("n")).orderBy(*key).collect()
    return train({(r["kind"], r["votes"], r["features"]): r["n"] for r in rows})


def spans_of(text: str | None, weights: np.ndarray, least: float = 0.5) -> tuple[list[Span], list[Span]]:
    """Exact spans, and all spans, in the order of kinds and starts."""
    if not text:
        return [], []
    base, more, told = _described(text)
    if more:
        own = weights[[ADDED.index(kind) for kind, _, _ in more]]
        p = 1 / (1 + np.exp(-(_one_hot([f for _, f in told]) * own).sum(axis=1)))
        more = [s for s, x in zip(more, p) if x > least]
    return base, sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1]))


def digest(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(docs: DataFrame, weights: np.ndarray, keep: list[str], least: float = 0.5) -> DataFrame:
    """The ``keep`` columns with counts of the exact kinds, base_sha256 and spans of each text.

    A null or empty text has no spans; repeated rows repeat; an empty table gives no row.
    """
    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column(batch.num_columns - 1)):
                found = [spans_of(t, weights, least) for t in texts]
                counts = [Counter(k for k, _, _ in base) for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(a, b - a).columns[:-1], *[pa.array([c[k] for c in counts], pa.int64()) for k in BASE],
                     pa.array([hashlib.sha256(digest(base).encode()).hexdigest() for base, _ in found], pa.string()),
                     pa.array([digest(every) for _, every in found], pa.string())],
                    names=[*keep, *[f"n_{k}" for k in BASE], "base_sha256", "spans"])

    schema = StructType(rows.schema.fields[:-1] + [StructField(f"n_{k}", LongType()) for k in BASE]
                        + [StructField("base_sha256", StringType()), StructField("spans", StringType())])
    return rows.mapInArrow(run, schema)


def masked(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span, or run of overlapping ones, replaced by its first kind in brackets."""
    if not text or not spans:
        return text
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out.append(text[at:a] + f"[{kind.upper()}]")
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, weights: np.ndarray, least: float = 0.5) -> DataFrame:
    """The documents with personal data replaced in text, and n_chars counted anew.

    A null or empty text stays as it is; rows that repeat are masked each; very long texts are
    masked whole, one at a time. All other columns stay, whatever their names. An empty table
    gives no row.
    """
    plain, (text,) = by_position(docs.withColumn("text", F.col("text").cast("string")), "text")
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            for a, b, texts in text_slices(batch.column(at)):
                part = batch.slice(a, b - a)
                texts = [masked(t, spans_of(t, weights, least)[1]) for t in texts]
                yield part.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = plain.mapInArrow(run, plain.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn(f"c{docs.columns.index('n_chars')}", F.length(text).cast("long"))
    return out.toDF(*docs.columns)
