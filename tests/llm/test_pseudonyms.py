import datetime
import itertools
import re

import pytest

from fixtures import awkward, docs_of
from segmint.llm import pseudonyms as P

KEY = b"a test key"


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000, 1024])
def test_permutation(size):
    assert sorted(P.permute(i, size, KEY, "x") for i in range(size)) == list(range(size))


@pytest.mark.parametrize("text,change", [
    ("4111111111111111", P.card), ("3782-822463-10005", P.card), ("123-45-6789", P.ssn), ("899-99-9999", P.ssn), ("+1 (743) 555-3824", P.phone), ("+49 30 1234567", P.phone),
    ("10.0.255.1", P.ipv4), ("a.b9+X@mail.example.com", P.email), ("GB82WEST12345698765432", P.iban), ("2020-02-29", P.date), ("29.02.2020", P.date),
    ("02/29/2020", P.date), ("31/12/1999", P.date)])
def test_pseudonyms_are_valid_and_of_the_same_form(text, change):
    new = change(text, KEY)
    assert new != text and change(new, KEY) is not None
    shape = lambda s: re.sub(r"[0-9]+" if change is P.ipv4 else r"[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", s)))
    assert shape(new) == shape(text)
    assert change(text, KEY) == new != change(text, b"another key")


@pytest.mark.parametrize("text,change", [("4111111111111112", P.card), ("666-12-1234", P.ssn), ("900-12-1234", P.ssn), ("123-00-1234", P.ssn), ("+1 143 555 3824", P.phone),
                                         ("256.0.0.1", P.ipv4), ("01.2.3.4", P.ipv4), ("GB82WEST12345698765433", P.iban), ("2021-02-29", P.date), ("13/32/2020", P.date)])
def test_invalid_values_stay(text, change):
    assert change(text, KEY) is None


def test_different_values_stay_different():
    days = [datetime.date(2000, 1, 1) + datetime.timedelta(i) for i in range(3000)]
    assert len({P.date(d.isoformat(), KEY) for d in days}) == 3000
    assert len({P.ssn(f"{a:03d}-{g:02d}-{s:04d}", KEY) for a, g, s in itertools.product(range(660, 672), range(1, 12), range(1, 12)) if a != 666}) == 11 * 121
    assert len({P.email(f"{a}{b}1@x.org", KEY) for a, b in itertools.product("abcdefghijkl", "ABCDEFGHIJ")}) == 120
    late = [f"{d:02d}/{m:02d}/1999" for d in range(13, 29) for m in range(1, 13)]
    new = {P.date(x, KEY) for x in late}
    assert len(new) == len(late) and all(int(x[:2]) > 12 and int(x[3:5]) <= 12 for x in new)


def test_one_date_has_one_pseudonym_in_its_forms():
    iso, dots, slashes = (P.date(x, KEY) for x in ("2020-03-04", "04.03.2020", "03/04/2020"))
    y, m, d = iso.split("-")
    assert dots == f"{d}.{m}.{y}" and slashes == f"{m}/{d}/{y}"


def test_equal_values_stay_linked_across_documents(spark):
    docs = docs_of(spark, [(1, "call +1 (743) 555-3824, 4111 1111 1111 1111"), (2, "é +1 (743) 555-3824!"), (3, "none 1.2.3 12 4111111111111112"), (4, None)])
    got = {r.doc_id: r for r in P.pseudonymize(docs, KEY).collect()}
    phone = got[1].pseudonyms[0].pseudonym
    assert [x.kind for x in got[1].pseudonyms] == ["phone", "card"]
    assert got[2].text == f"é {phone}!" and got[2].pseudonyms[0].start == 2
    assert got[3].text.startswith("none") and got[3].pseudonyms == [] and got[4].text is None and got[4].pseudonyms == []


def test_awkward_rows(spark):
    out = P.pseudonymize(awkward(spark), KEY)
    assert out.columns == [*awkward(spark).columns, "pseudonyms_"] and out.count() == 10
    assert P.pseudonymize(awkward(spark).limit(0), KEY).count() == 0


@pytest.mark.parametrize("text", ["+1 (017) 555-7713", "+1 (132) 555-1352", "+1 743 155 3824", "+10175557713"])
def test_every_ten_digit_number_gets_a_pseudonym(text):
    new, found = P.pseudonymize_text(f"call {text}.", KEY)
    assert [x[:3] for x in found] == [("phone", 5, 5 + len(text))] and text not in new
    assert re.sub("[0-9]", "9", new) == re.sub("[0-9]", "9", f"call {text}.")
    assert P.phone(found[0][3], KEY) is None and P.other_phone(found[0][3], KEY) is not None


def test_numbers_outside_the_plan_stay_different():
    texts = [f"+1{a:03d}{x:03d}{n:04d}" for a in (0, 17, 199, 200, 999) for x in (0, 1, 100, 199) for n in (0, 9999)]
    new = {P.other_phone(t, KEY) for t in texts}
    assert None not in new and len(new) == len(texts) and all(re.fullmatch(r"\+1\d{10}", x) for x in new)
    assert P.other_phone("+1 743 555 3824", KEY) is None


@pytest.mark.parametrize("text,found", [
    ("+1 (826) 555-4081 190.137.223.204", ["+1 (826) 555-4081", "190.137.223.204"]), ("+1 (826) 555-4081 42 cats", ["+1 (826) 555-4081"]),
    ("+1 (826) 555-4081 123-45-6789", ["+1 (826) 555-4081", "123-45-6789"]), ("+1 826 555 4081 2020-02-29", ["+1 826 555 4081", "2020-02-29"]),
    ("+49 30 1234567 10.20.30.40", ["+49 30 1234567", "10.20.30.40"]), ("+49 30 1234567 4111 1111 1111 1111", ["+49 30 1234567", "4111 1111 1111 1111"]),
    ("+1 (826) 555-4081 555-123-4567", ["+1 (826) 555-4081", "555-123-4567"]), ("(555) 123-4567 or 1-800-555-0199", ["(555) 123-4567", "1-800-555-0199"]),
    ("GB82 WEST 1234 5698 7654 32 THEN", ["GB82 WEST 1234 5698 7654 32"]), ("BE68 5390 0754 7034 BE68 5390 0754 7034", ["BE68 5390 0754 7034"] * 2),
    ("version 1.2.3 of 10 200 3000, part 12-345-6789, +1 826 555 40811, GB82 WEST 1234 5698 7654 33", [])])
def test_values_beside_others_and_in_groups(text, found):
    new, spans = P.pseudonymize_text(f"é {text} x", KEY)
    assert [f"é {text} x"[s:e] for _, s, e, _ in spans] == found
    assert not any(f in new for f in found) and re.sub("[A-Z]", "A", re.sub("[0-9]+", "9", new)) == re.sub("[A-Z]", "A", re.sub("[0-9]+", "9", f"é {text} x"))


def test_forms_of_one_value_stay_linked():
    assert P.any_phone("826-555-4081", KEY).replace("-", "") == P.any_phone("+1 (826) 555-4081", KEY)[2:].translate({ord(c): None for c in "() -"})
    assert P.any_iban("GB82 WEST 1234 5698 7654 32", KEY).replace(" ", "") == P.iban("GB82WEST12345698765432", KEY)


def test_time_is_linear_in_the_finds():
    import time
    line = "mail a.b@example.org on 2024-02-03 from 10.1.2.3 or +1 (212) 555-0134, "
    text = line * 12_000
    start = time.process_time()
    new, found = P.pseudonymize_text(text, b"key")
    assert len(found) % 12_000 == 0 and len(found) >= 36_000 and time.process_time() - start < 30
    assert [f[3] for f in found[:len(found) // 12_000]] == [f[3] for f in found[-(len(found) // 12_000):]]
