"""Shapes of personal data beyond those of the given tables."""

import ipaddress
import re

import pyarrow as pa
import pyarrow.compute as pc

from larkspur.llm import pii

PHONES = ["+44 20 7946 0958", "+49 30 1234567", "+33 1 23 45 67 89", "01 23 45 67 89", "+34 912 345 678", "(030) 1234567", "912 34 56 78",
          "+44 (0)20 7946 0958", "030/1234567", "0171-1234567", "8 (495) 123-45-67", "+7 495 123-45-67", "01.23.45.67.89", "01\u00a023\u00a045\u00a067\u00a089"]
CARDS = ["378282246310005", "3782 822463 10005", "4222222222222", "6304000000000000000", "4111 1111 1111 1111", "30569309025904"]
ADDRESSES = ["2001:db8::8a2e:370:7334", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1", "2001:DB8::FF00:42:8329"]
OTHER = ["01.02.2024 12:30", "at 12:30:45 on 2024-01-02", "std::vector a::b :: x::", "1700000000000", "378282246310006", "v 1.2.3", "3.14159265358979",
         "0.1234567890", "1,234,567,890", "page 12 of 345", "::1"]


def kinds(text):
    return [(text[a:z], k) for a, z, k in pii.detect(text)]


def test_phones_cards_and_addresses_are_found_whole():
    for shapes, kind in ((PHONES, "phone"), (CARDS, "card"), (ADDRESSES, "ip")):
        for s in shapes:
            for text in (s, f"call {s}.", f"({s}), x", f"x: {s}\ny"):
                assert kinds(text) == [(s, kind)], text
                assert pc.match_substring_regex(pa.array([text]), pii.MAY_HOLD)[0].as_py()
    for text in OTHER:
        assert kinds(text) == [], text
    assert kinds("3782 822463 10005 2024") == [("3782 822463 10005", "card")]


def test_surrogates_of_wider_shapes_keep_format():
    for s in PHONES + CARDS + ADDRESSES:
        made, _ = pii.replace(pii.KEY, f"x {s} y {s}", {})
        first, again = re.fullmatch(r"x (.*) y (.*)", made).groups()
        assert first == again != s
        if s in ADDRESSES:
            old, new = (ipaddress.IPv6Address(v).exploded.split(":") for v in (s, first))
            assert old[0] == new[0] and [g == "0000" for g in old] == [g == "0000" for g in new]
        else:
            assert re.sub(r"\d", "0", first) == re.sub(r"\d", "0", s)
        if s in CARDS:
            d = re.sub(r"\D", "", first)
            assert (int(d[-1]) + pii._luhn(d[:-1])) % 10 == 0
    one = {pii.surrogate(b"k", "ip6", ipaddress.IPv6Address(f"fe80::{i:x}").exploded) for i in range(1, 3000)}
    assert len(one) == 2999


def test_surnames_recur_alone(spark):
    rows = [(1, "Schmidt came. Anna Schmidt said so; SCHMIDT's dog, Schmidtke's cat, Иван Петров и Петров."), (2, "Schmidt alone.")]
    got = {r["doc_id"]: (r["text"], r["pii_counts"][4]) for r in pii.protect(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    a, given, b, c, ivan, d, e = re.fullmatch(r"(\w+) came. (\w+) (\w+) said so; (\w+)'s dog, Schmidtke's cat, (\w+) (\w+) и (\w+)\.", got[1][0]).groups()
    assert a == b == c.title() != "Schmidt" and c.isupper() and d == e != "Петров" and got[1][1] == 5
    assert got[2] == ("Schmidt alone.", 0)


def test_names_are_known_by_their_place(spark):
    texts = ["Please ask Dr. Vandermeer about it. Vandermeer knows.", "Dear Mr Oyelaran,\nthank you.\nKind regards,\nSiobhan Quigley\nThe end.",
             "Write to tamsin.okafor@mail.example. Tamsin Okafor will reply; Okafor is in.", "Liebe Frau Özdemir, hallo.\nViele Grüße\nBjörn Åkesson",
             "Уважаемый Ярополк Затейников, здравствуйте. Затейников тут."]
    for text in texts:
        made, found = pii.replace(pii.KEY, text, {})
        assert pc.match_substring_regex(pa.array([text]), pii.MAY_HOLD)[0].as_py()
        for name in ("Vandermeer", "Oyelaran", "Siobhan", "Quigley", "Tamsin", "Okafor", "Özdemir", "Björn", "Åkesson", "Ярополк", "Затейников"):
            assert name not in made, made
        assert found.count("name") >= 2 or "Oyelaran" in text
    first, again = re.fullmatch(r"Please ask Dr. (\w+) about it. (\w+) knows.", pii.replace(pii.KEY, texts[0], {})[0]).groups()
    assert first == again                                       # one person stays one person
    for text in ("Dear All,\nthe Team met. All came.", "Dear Customer, hello Customer.", "The Don river. Miss it.\nRegards,\nthe team"):
        assert [k for _, k in kinds(text)] == [], text
    got = pii.protect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r["text"] for r in sorted(got, key=lambda r: r["doc_id"])] == [pii.replace(pii.KEY, t, {})[0] for t in texts]


def test_country_codes_stay():
    for s, code in (("+44 20 7946 0958", "+44"), ("+1 212 555 0100", "+1"), ("+353 1 679 9000", "+353"), ("+7 495 123-45-67", "+7"), ("+4930123456", "+49")):
        made = {pii.replace(key, s, {})[0] for key in (b"a", b"b", b"c")}
        assert all(m.startswith(code) and len(m) == len(s) for m in made) and len(made) == 3


def test_room_for_any_number_of_surnames(spark):
    names = spark.range(100_000).selectExpr("'surname-latin' AS kind", "concat('n', id) AS value")
    redrawn = {r["value"]: r["nonce"] for r in pii.settle(names, b"k").collect()}
    made = {pii.surrogate(b"k", "surname-latin", f"n{i}", redrawn.get(f"n{i}", 0)) for i in range(100_000)}
    assert len(made) == 100_000 and len(redrawn) < 1000
