import ipaddress
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from ledgerloom.llm import pii

MIDDLE = "/root/testdata/sf0.01"


def replaced(spark, texts, key="k"):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id int, text string, mentions int")
    rows = pii.replace_personal_data(docs, key).collect()
    assert all(r.row.mentions == 7 for r in rows)
    return {r.row.doc_id: r for r in rows}


def luhn(text):
    digits = [int(c) for c in re.sub(r"\D", "", text)]
    return sum(d if at % 2 == 0 else d * 2 - 9 * (d > 4) for at, d in enumerate(reversed(digits))) % 10 == 0


CASES = {
    "mail a.b@x.com and A.B@X.com": ["mail", "mail"],
    "card 4111 1111 1111 1111 or 4111-1111-1111-1111, 4111111111111111 not 4111 1111 1111 1112": ["card"] * 3,
    "+1 (017) 555-7713 4111111111111111 10.20.30.40 +1 (017) 555-7713": ["phone", "card", "ip", "phone"],
    "4111111111111111 129.190.225.188 x.y@mail.example.com": ["card", "ip", "mail"],
    "1.2.3.4.5 999.1.1.1 2024-01-02 10:00 version 2.0. 12": [],
    "Mr. John Smith met Mrs Jane Smith; Herr Krüger, Mme Dupont-Aignan; господин Иван Петров": ["name"] * 5,
    "ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00 end": ["ssn", "iban"],
    "иван.п@почта.example.com иван.п@mail.example.com": ["mail"],
    "Smith and Herring, the Mister": [],
}


def test_types_formats_and_coreference(spark):
    texts = list(CASES)
    got = replaced(spark, texts)
    for i, text in enumerate(texts):
        found = got[i].mentions or []
        assert [m.kind for m in found] == CASES[text], text
        want = text
        for m in found:
            assert m.surrogate != m.mention and m.mention not in got[i].replaced
            want = want.replace(m.mention, m.surrogate)
            shape = lambda s: re.sub(r"\d", "9", s)
            if m.kind in ("card", "phone", "ssn", "iban"):
                assert shape(m.surrogate) == shape(m.mention)
            if m.kind == "card":
                assert luhn(m.surrogate) and m.surrogate[0] == m.mention[0]
            if m.kind == "iban":
                plain = m.surrogate.replace(" ", "")
                assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
            if m.kind == "ip":
                assert all(0 <= int(x) < 256 for x in m.surrogate.split("."))
        assert got[i].replaced == want
    mails, cards = got[0].mentions, got[1].mentions
    assert mails[0].surrogate == mails[1].surrogate
    assert len({re.sub(r"\D", "", m.surrogate) for m in cards}) == 1
    john, jane, kruger, dupont, ivan = (m.surrogate for m in got[5].mentions)
    assert john.startswith("Mr. ") and john.split()[1].endswith("n") and jane.split()[1].endswith("a") and len(kruger.split()) == 2
    assert re.fullmatch(r"господин [А-Я][а-я]+н [А-Я][а-я]+", ivan)
    assert re.fullmatch(r"[а-я]+\.\d+@mail\d\.example\.org", got[7].mentions[0].surrogate)


def test_untitled_repeats_and_shared_families(spark):
    texts = [
        "Mr John Smith called. John Smith and Smith, not Smithson or Blacksmith-Smith; Dr Anna Lee wrote, Lee said.",
        "Mr Smith met Mrs Anna Lee.", "MR SMITH wrote", "Smith and John Smith stay here.", "Mr Juan de la Cruz; Cruz left. Frau von Stein",
        "Mrs Maria Anna Luisa Sofia Lopez is here",
    ]
    got = [replaced(spark, texts)[i].replaced for i in range(len(texts))]
    john, smith = re.match(r"Mr (\w+) (\w+) called", got[0]).groups()
    assert got[0].startswith(f"Mr {john} {smith} called. {john} {smith} and {smith}, not Smithson or Blacksmith-Smith; Dr ")
    anna, lee = re.search(r"Dr (\w+) (\w+) wrote", got[0]).groups()
    assert got[0].endswith(f"wrote, {lee} said.")
    assert re.fullmatch(rf"Mr {smith} met Mrs {anna[:-1]}a {lee}\.", got[1])
    assert got[2] == f"MR {smith.upper()} wrote" and got[3] == texts[3]
    assert not re.search("Juan|Cruz|Stein", got[4]) and re.fullmatch(r"Mrs \w+a \w+ \w+ is here", got[5])


def test_country_codes_and_kinds_of_addresses(spark):
    texts = ["+44 20 7946 0958 or +442079460958", "+1 (017) 555-7713", "+358 40 123 4567", "192.168.0.1 10.0.0.7 172.20.1.1 127.0.0.1 8.8.8.8 169.254.1.1"]
    got = replaced(spark, texts)
    one, other = (m.surrogate for m in got[0].mentions)
    assert one.startswith("+44 ") and re.sub(r"\D", "", one) == re.sub(r"\D", "", other) and got[1].mentions[0].surrogate.startswith("+1 (")
    assert got[2].mentions[0].surrogate.startswith("+358 ") and re.fullmatch(r"\+358 \d\d \d{3} \d{4}", got[2].mentions[0].surrogate)
    addresses = [ipaddress.ip_address(m.surrogate) for m in got[3].mentions]
    assert [a.is_private for a in addresses] == [True, True, True, True, False, True]
    assert addresses[3].is_loopback and addresses[4].is_global and len(set(addresses)) == 6


def test_keys_decide_and_runs_agree(spark):
    text = ["a.b@x.com 10.20.30.40 +1 (017) 555-7713"]
    one, same, other = (replaced(spark, text, k)[0].replaced for k in ("k", "k", "l"))
    assert one == same and one != other


def by_hand(entities, key, value):
    """Attempts by repeated search for pairs, in plain Python."""
    attempt = dict.fromkeys(entities, 0)
    while True:
        taken = defaultdict(list)
        for e in entities:
            taken[value(e, attempt[e])].append((attempt[e], e))
        again = {e for v, es in taken.items() if v in attempt for _, e in es} | {e for es in taken.values() for _, e in sorted(es)[1:]}
        if not again:
            return attempt
        for e in again:
            attempt[e] += 1


def test_collisions_are_resolved(spark, monkeypatch):
    """A space of 40 surrogates, some of them real entities, for 12 entities."""
    small = lambda kind, entity, key, attempt: F.concat(F.lit("10.0.0."), F.pmod(F.xxhash64(entity, attempt), F.lit(40)).cast("string"))
    monkeypatch.setattr(pii, "surrogate", small)
    names = [f"10.0.0.{i}" for i in range(0, 24, 2)]
    entities = spark.createDataFrame([("ip", n) for n in names], "kind string, entity string")
    tries = entities.select("entity", F.explode(F.sequence(F.lit(0), F.lit(50))).alias("attempt")).select("entity", "attempt", small(None, F.col("entity"), "", F.col("attempt")).alias("v"))
    value = {(r.entity, r.attempt): r.v for r in tries.collect()}
    got = pii.settle_surrogates(entities, "k").collect()
    assert {r.entity: r.attempt for r in got} == by_hand(names, "k", lambda e, a: value[e, a])
    values = [r.value for r in got]
    assert len(set(values)) == len(names) and not set(values) & set(names) and any(r.attempt for r in got)
    texts = [" and ".join(names[i : i + 3]) for i in range(10)]
    rows = replaced(spark, texts)
    final = {r.entity: r.value for r in got}
    for i, t in enumerate(texts):
        assert rows[i].replaced == re.sub(r"10\.0\.0\.\d+", lambda m: final[m.group()], t)
    too_many = spark.createDataFrame([("ip", f"10.0.1.{i}") for i in range(60)], "kind string, entity string")
    with pytest.raises(ValueError, match="collide"):
        pii.settle_surrogates(too_many, "k")


def test_whole_documents(spark):
    rows = registry.queries()["op8_pii"](spark, MIDDLE).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    mention = re.compile(r"\S+@\S+\.example\.com|\+1 \(\d{3}\) 555-\d{4}|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d)|(?<!\d)\d{16}(?!\d)")
    pairs = defaultdict(set)
    for r in rows:
        old = [m.group() for m in mention.finditer(texts[r.doc_id])]
        old = [m for m in old if not re.fullmatch(r"\d{16}", m) or luhn(m)]
        assert r.n_replaced == len(old)
        assert all(m not in r.text for m in old)
        assert old or r.text == texts[r.doc_id]
        fixed = re.split("|".join(map(re.escape, sorted(old, key=len, reverse=True))), texts[r.doc_id]) if old else []
        parts = re.fullmatch("(.+?)".join(map(re.escape, fixed)), r.text, re.S) if old else None
        assert not old or parts
        for m, s in zip(old, parts.groups() if parts else ()):
            pairs[m].add(s)
    assert len(pairs) > 20 and all(len(s) == 1 for s in pairs.values())
    assert len({next(iter(s)) for s in pairs.values()}) == len(pairs)


def test_edge_cases_and_plan(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (2, "a.b@x.com", "y"), (2, "a.b@x.com", "y"), (None, "no data", "z")], "doc_id int, text string, replaced string")
    out = pii.with_surrogates(docs, "k")
    assert out.columns == docs.columns and out.count() == 5
    assert {r.text for r in out.where("doc_id = 1 or doc_id is null").collect()} == {None, "", "no data"}
    assert pii.with_surrogates(docs.limit(0), "k").count() == 0
    plan = pii.replace_personal_data(docs.select("doc_id", "text"), "k")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
