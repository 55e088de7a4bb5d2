"""Added spans of personal data on planted forms: how many are found, and how many found are right."""

import random

import pytest

from tests.llm.helpers import awkward, empty
from tidemark.llm import pii

LOW = "river stone window garden morning letter quiet market winter harbor road paper signal copper field story number people small always".split()
FAMILY = "Falkner Oduya Brandt Kessler Moreau Castellan Novakova Lindqvist Haverford Okonkwo Petrescu Yamazaki Delacroix Thornbury Vasquez".split()
GIVEN = "James Maria Thomas Sabine Claire Pedro Oluwaseun Ingrid Tadeusz Yuki Marguerite Dieter".split()


def iban(rng, country):
    body = "".join(rng.choice("0123456789") for _ in range(18))
    check = 98 - int("".join(str(int(c, 36)) for c in f"{body}{country}00")) % 97
    return f"{country}{check:02d}{body}"


def spaced(s):
    return " ".join(s[k : k + 4] for k in range(0, len(s), 4))


def personal(rng):
    """A kind, a form of it, and a frame around it."""
    given, family = rng.choice(GIVEN), rng.choice(FAMILY)
    digits = "".join(rng.choice("0123456789") for _ in range(8))
    key = "".join(rng.choice("abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ0123456789") for _ in range(32)) + "a1b2c3"
    return rng.choice([
        ("iban", spaced(iban(rng, rng.choice(["DE", "FR", "ES"]))), "transfer it to {} before noon"),
        ("iban", iban(rng, "GB"), "konto {} is open"),
        ("ident", f"{digits[:3]}-{digits[3:5]}-{digits[:4]}", "his ssn is {} on file"),
        ("ident", f"{digits}{pii.ID_LETTERS[int(digits) % 23]}", "con dni {} en la lista"),
        ("street", f"{digits[:3].lstrip('0') or '7'} {rng.choice(FAMILY)} Street, Springfield, IL 62704", "address: {} since then"),
        ("street", f"{rng.choice(['Linden', 'Garten', 'Schiller'])}straße {digits[:2].lstrip('0') or '4'}, 10115 Berlin", "wohnhaft {} seit langem"),
        ("secret", f"sk-{key}", "api key = {} in the file"),
        ("name", f"{given} {family}", "please call Dr. {} at once"),
        ("name", f"{rng.choice(GIVEN[:6])} {family}", "dear {} and others"),
        ("name", f"{given} {family}", "contact: {}, x@mail.example for more"),
        ("address", f"{family.lower()} [at] gmail [dot] com", "mail me: {} any time"),
    ])


def harmless(rng):
    n = "".join(rng.choice("123456789") for _ in range(9))
    return rng.choice([
        f"version {n} of the build", f"order {n} was sent", f"page {n[:3]} of part {n}", "The Winter Garden Story begins",
        "the Old Harbor Road market", "licensed under the Copper Public License", "isbn 978-3-16-148410-0 is a book",
        f"the total of ${n} was paid", "a Small Paper Signal was lit", f"figure {n[:2]} and table {n[2:4]}",
        f"model X{n[:7]} of the year",
    ])


def corpus(rng, many):
    """Texts and their planted spans."""
    out = []
    for _ in range(many):
        text, planted = "", []
        for _ in range(rng.randint(1, 6)):
            text += " ".join(rng.choice(LOW) for _ in range(rng.randint(12, 30))) + " "
            if rng.random() < 0.5:
                text += harmless(rng)
            else:
                kind, form, frame = personal(rng)
                at = len(text) + frame.index("{}")
                text += frame.format(form)
                planted.append((kind, at, at + len(form)))
            text += ". "
        out.append((text, planted))
    return out


@pytest.fixture(scope="module")
def planted(spark):
    texts = corpus(random.Random(11), 1500)
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string")
    return pii.learn(docs.repartition(5)), texts


def test_planted_spans_are_found_and_little_else(planted):
    weights, _ = planted
    found = wanted = right = given = 0
    missed = {}
    for text, spans in corpus(random.Random(12), 1500):  # other texts than those learned from
        base, every = pii.spans_of(text, weights)
        added = set(every) - set(base)
        hit = {s for s in spans if any(a < s[2] and s[1] < b for _, a, b in added)}
        for s in set(spans) - hit:
            missed[s[0]] = missed.get(s[0], 0) + 1
        found, wanted = found + len(hit), wanted + len(spans)
        right += sum(any(a < q and p < b for _, p, q in spans) for _, a, b in added)
        given += len(added)
    assert wanted > 2000 and found >= 0.95 * wanted, (found, wanted, missed)
    assert right >= 0.95 * given, (right, given)


def test_masked_texts_hold_no_planted_number(planted):
    weights, texts = planted
    left = 0
    for text, spans in texts:
        masked = pii.masked(text, pii.spans_of(text, weights)[1])
        left += sum(text[a:b] in masked for kind, a, b in spans if kind in ("iban", "ident", "secret"))
    assert left <= 0.02 * sum(kind in ("iban", "ident", "secret") for _, spans in texts for kind, _, _ in spans)


def test_weights_do_not_depend_on_partitions(spark, planted):
    weights, texts = planted
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string")
    assert (pii.learn(docs.repartition(2)) == weights).all()


def test_account_ends_where_its_check_digits_hold():
    good = spaced(iban(random.Random(3), "DE"))
    (span,) = pii.candidates(f"x {good} AND SO ON", [])
    assert span == ("iban", 2, 2 + len(good))
    bad = good[:-1] + str((int(good[-1]) + 1) % 10)
    assert pii._checked("iban", bad) == "0" and pii._checked("iban", good) == "1"


def test_labelers_that_vote_one_way_tell_something():
    rng = random.Random(4)
    votes = {}
    for _ in range(20_000):
        truth = rng.random() < 0.3
        rates = [(0.6, 0.02, "1"), (0.05, 0.5, "0"), (0.5, 0.03, "1"), (0.05, 0.4, "0")]  # where true, where not
        code = "".join(vote if rng.random() < (t if truth else f) else "-" for t, f, vote in rates)
        votes[code] = votes.get(code, 0) + 1
    true, false, share, posterior = pii.estimate(votes)
    assert abs(share - 0.3) < 0.05 and abs(true[0] - 0.6) < 0.06 and abs(false[0] - 0.02) < 0.02
    assert posterior["1-1-"] > 0.95 > 0.5 > posterior["----"] > posterior["-0-0"]


def test_long_texts_of_one_form_take_linear_time():
    import time

    for unit in ("Sich ", "Th Th-", "DE89 3704 ", "12 Old ", "a@b Mr. ", "A1234567 ", "Ab Cd. "):
        text = unit * (400_000 // len(unit))
        begin = time.perf_counter()
        pii._described(text)
        assert time.perf_counter() - begin < 10, unit


def test_planted_run_takes_awkward_tables(spark, planted):
    weights, _ = planted
    assert pii.find(awkward(spark), weights, ["doc_id"]).count() == awkward(spark).count()
    assert pii.mask(empty(spark), weights).count() == 0
