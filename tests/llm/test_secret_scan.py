import hashlib
import random
import re
import string

import pytest
from conftest import SF_SMALL

from fixtures import awkward, docs_of, table
from segmint.llm import secret_scan as S

PLAIN = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
          lambda m: len(m.group(2)) >= 6),
         ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m.group()) >= 20),
         ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m.group()) >= 24))


def base(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(PLAIN) for m in p.finditer(text or "") if ok(m)]
    return [f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found)]


def test_digests_equal_a_plain_scan(spark):
    docs = table(spark, SF_SMALL, "documents").unionByName(docs_of(spark, [
        (9001, "é token='abcdef' TOKEN=abc AKIA" + "Z" * 16 + " " + "0a" * 13), (9002, None), (9003, "api_key:  'a/b+c=' ſecret=abcdefgh"),
        (9004, "password=abcdefg" + "0123456789abcdef" * 4)]).selectExpr("doc_id", "text", "'x' lang", "'y' source", "0L n_chars"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = S.secret_digests(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = base(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), r.doc_id
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == want
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in want) for k in ("assign:", "access:", "hex:"))


@pytest.mark.parametrize("run,expected", [
    (b"wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY", True), (b"c29tZXRoaW5nLXJhbmRvbS1oZXJl", False),  # says "something-random-here"
    (b"a2V5IGlzIHdKYWxyWFV0bkZFTUlLN01ERU5HYlB4", True),  # says "key is wJalrXUtnFEMIK7MDENGbPx"
    (b"ThisIsACamelCaseIdentifier2Name", False), (b"d41d8cd98f00b204e9800998ecf8427e", False),
    (b"123e4567-e89b-12d3-a456-426614174000", False), (b"12345678901234567890123", False), (b"one-two-three-four-5-six-seven", False)])
def test_token_efficiency(run, expected):
    assert S.is_random(run, S.vocabulary_path(), 1.9) is expected


def test_awkward_rows(spark):
    rows = S.find_secrets(awkward(spark)).collect()
    assert len(rows) == 10 and {len(r) for r in rows} == {11}
    spans = {r.doc_id: r.secret_spans_ for r in rows}
    assert spans[3] == [] and spans[4] == [] and len(spans[6]) == 1
    assert S.find_secrets(awkward(spark).limit(0)).count() == 0


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é token = 'abcdef0123456789abcdef0123456789' end", 7), (2, "plain", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in S.redact_secrets(docs).collect()}
    assert out[1].text == "é [SECRET]' end" and out[1].n_chars == len(out[1].text)
    assert out[2].text == "plain" and out[2].n_chars == 5 and out[3].text is None
    assert S.redact_secrets(awkward(spark)).columns == awkward(spark).columns


@pytest.mark.parametrize("before,after", [("authorization_bearer_value=", ""), ("/usr/local/share/application/settings/", ""),
                                          ("https://example.com/callback/of/application/", "/settings?x=1"), ("client-credential-value=", " end")])
@pytest.mark.parametrize("length", [20, 24])
def test_random_parts_behind_words_are_found(before, after, length):
    rnd = random.Random(5)
    for _ in range(100):
        key = "".join(rnd.choices(string.ascii_letters + string.digits, k=length))
        spans = S.spans_of(f"é {before}{key}{after}".encode(), S.vocabulary_path(), 1.9)
        at = 2 + len(before)
        assert any(s <= at and at + length <= e for _, s, e in spans), key


def test_base64_behind_words_is_found_whole():
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYq8Zk1KEY9="
    text = f"/usr/local/share/application/settings/authorization/credentials={key}"
    assert S.spans_of(text.encode(), S.vocabulary_path(), 1.9) == [("random", text.index(key), len(text))]


@pytest.mark.parametrize("text", ["/usr/local/share/application/settings/authorization/values", "https://example.com/users/123e4567-e89b-12d3-a456-4a6b1c1d40f0/application/settings",
                                  "use_application_settings=ThisIsACamelCaseIdentifier2Name", "backup/of/the/database-2024-01-31/part-00017", "/usr/local/share/application/settings/D41D8CD98F00B204E9800998ECF8427E"])
def test_words_and_known_forms_in_paths_stay(text):
    assert S.spans_of(text.encode(), S.vocabulary_path(), 1.9) == []


def test_redaction_behind_words(spark):
    key = "q7Zk2VbX9LmT4RwJ8sPd"
    docs = docs_of(spark, [(1, f"see /usr/local/share/application/settings/of/authorization/{key}/and/other/things now")])
    text = S.redact_secrets(docs).first().text
    assert text.startswith("see ") and text.endswith(" now") and "[SECRET]" in text and key not in text


KNOWN = ["/users/123e4567-e89b-42d3-a456-426614174000/edit", "id=123E4567-E89B-42D3-A456-426614174000", "session-123e4567-e89b-42d3-a456-426614174000",
         "commit/da39a3ee5e6b4b0d3255bfef95601890afd80709", "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=",
         "sha512-z4PhNX7vuL3xVChQ1m2AB9Yg5AULVxXcg/SpIdNs6c5H0NE8XYXysP+DGNKHfuwvY7kxvUdBeoGlODJ6+SfaPg==",
         "SHA256:uNiVztksCsDhcc0u9e8BrdCjXNmFKVSGdWBeWHNFwEU", "01ARZ3NDEKTSV4RRFFQ69G5FAV", "/events/01ARZ3NDEKTSV4RRFFQ69G5FAV/raw", "VGhlIHF1aWNrIGJyb3duIGZveCBqdW1wcyBvdmVyIHRoZSBkb2c="]


def test_known_forms_are_left_out_and_what_is_beside_them_is_not():
    rng = random.Random(11)
    for known in KNOWN:
        spans = S.spans_of(known.encode(), S.vocabulary_path(), 1.9)
        assert not [x for x in spans if x[0] == "random"], known
    for _ in range(60):
        secret, known = "".join(rng.choices(string.ascii_letters + string.digits, k=32)), rng.choice(KNOWN[:8])
        text = f"{known}/{secret}"
        got = [text[s:e] for k, s, e in S.spans_of(text.encode(), S.vocabulary_path(), 1.9) if k == "random"]
        assert any(secret in g for g in got) and not any("4266" in g or "da39" in g for g in got), text


def test_time_is_linear_in_the_finds():
    import time
    rng = random.Random(1)
    line = lambda: f"password = {rng.randrange(10 ** 9):09d}x key " + "".join(rng.choices(string.ascii_letters + string.digits, k=30)) + "\n"
    text = "".join(line() for _ in range(30_000)).encode()
    start = time.process_time()
    assert sum(k == "assign" for k, _, _ in S.spans_of(text, S.vocabulary_path(), 1.9)) == 30_000 and len(text) > 1_700_000
    assert time.process_time() - start < 10
