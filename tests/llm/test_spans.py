"""Personal data, secrets and licences against plain patterns."""

import hashlib
import random
import re

from llm_fixtures import SF_SMALL, duck, odd_docs, small_docs  # noqa: F401

from adpulse.llm import blob_ledger, licenses, pii
from adpulse.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def plain_pii(t):
    t = t or ""
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(t)
            if 13 <= sum(c.isdigit() for c in m[0]) <= 19 and luhn(m[0])]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def plain_secrets(t):
    t = t or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(t) if len(m[0]) >= 32]
    return [(k, s, e) for s, _, k, e in sorted(out)]


def random_texts(pieces, n=3000, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_pii_matches_the_plain_patterns():
    pieces = ["a", "b.c", "@", "x-1", ".", "10", "255", "256", "192.168.1.1", " ", "-", "+", "+1 (555) 010-2030",
              "4111111111111111", "4111 1111 1111 1111", "00", "%", "é", "(", ")"]
    for t in random_texts(pieces):
        assert [s[:3] for s in pii.find_spans(t) if s[0] in pii.BASE_KINDS] == plain_pii(t), t


def test_secrets_match_the_plain_patterns():
    pieces = ["password", "PASSWD", "token", "api_key", "ApiKey", "secret", " ", "=", ":", '"', "'", "abcdefgh", "12345678",
              "AKIA", "ABCDEFGH12345678", "deadbeef" * 4, "0", "z", "ſ"]
    for t in random_texts(pieces):
        got = [s[:3] for s in blob_ledger.find_secrets(t) if s[0] in blob_ledger.BASE_KINDS]
        assert got == plain_secrets(t), t


def test_private_keys_reach_their_end(spark):
    import base64

    import corpus_pipeline
    raw = base64.b64encode(random.Random(3).randbytes(601)).decode()
    body = [raw[i:i + 64] for i in range(0, len(raw), 64)]
    begin, end, texts = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", []
    for sep in ("\n", "\r\n", "\\n", " ", "\n> "):
        for last in ([end], [], ["-----END RSA PRIV"]):
            texts.append("words before " + sep.join([begin, *body, *last]) + "\n\nand words after")
    texts.append(f"words before {begin}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0011\n\n" + "\n".join(body) + "\nand words after")
    texts.append(f"words before {begin}\n{body[0]}\n{begin}\n{body[1]}\n{end} and words after")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    masked = corpus_pipeline.mask_secrets(spark, docs, "").collect()
    assert len(masked) == len(texts)
    for r in masked:
        assert r.text.startswith("words before <private_key>") and r.text.endswith("and words after"), r.text
        assert not any(line[i:i + 4] in r.text for line in body for i in range(len(line) - 3)), r.text
    prose = f"the line {begin} starts a key file. Note: it is plain text"
    assert [prose[s:e] for _, s, e, _ in blob_ledger.find_secrets(prose)] == [begin]


def test_url_logins_of_any_length():
    for login in ("oauth2:" + "a1" * 60, ":pw", "u" * 80 + ":pass", "me:a:b"):
        assert blob_ledger.mask(*(lambda t: (t, [s[:3] for s in blob_ledger.find_secrets(t)]))(f"at https://{login}@host/x")) == "at <url_login>host/x"
    assert blob_ledger.find_secrets("see http://host:80/a@b") == []


def test_long_secrets_take_linear_time():
    import time
    begin = "-----BEGIN PRIVATE KEY-----"
    for t in ("-----BEGIN " + "A " * 200_000, begin * 40_000, "a://" * 100_000, "a://x:" * 80_000, "ab://" + "x" * 400_000,
              "ab://:" + "x" * 400_000, begin + "A" * 400_000, begin + "A b " * 100_000, begin + " " * 400_000,
              begin + "Version:" * 50_000, begin + ("A" * 16 + " ") * 20_000 + ".", begin + ("A" * 16 + "é") * 20_000):
        start = time.perf_counter()
        blob_ledger.find_secrets(t)
        assert time.perf_counter() - start < 5, t[:40]


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def test_span_queries_against_brute_force(spark, small_docs):
    got4 = {r.doc_id: r for r in QUERIES["op4_pii"](spark, SF_SMALL).collect()}
    got8 = {r.doc_id: r for r in QUERIES["op8_secrets"](spark, SF_SMALL).collect()}
    assert len(got4) == len(got8) == len(small_docs)
    for doc_id, text, _, _ in small_docs:
        p, s = plain_pii(text), plain_secrets(text)
        assert got4[doc_id].base_sha256 == digest(p) and got4[doc_id].n_email == sum(k == "email" for k, _, _ in p)
        assert got8[doc_id].base_sha256 == digest(s) and got8[doc_id].n_hex == sum(k == "hex" for k, _, _ in s)


def test_checksums_context_and_new_kinds():
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")
    kinds = lambda t: [s[0] for s in pii.find_spans(t)]
    assert "iban" in kinds("IBAN: GB82 WEST 1234 5698 7654 32.")
    assert "ssn" in kinds("social security number 123-45-6789") and "ssn" not in kinds("part 123-45-6789 in stock")
    near = pii.find_spans("my card is 4111111111111111")[0]
    far = pii.find_spans("order serial 4111111111111111")[0]
    assert near[3] > far[3]


def test_iban_before_capital_words():
    for iban in ("AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"):
        for after in (" BIC OPSKATWW", " BANK", " OPSKATWW", " BE68 5390 0754 7034", ".", ""):
            t = "IBAN " + iban + after
            got = [t[s:e] for k, s, e, _ in pii.find_spans(t) if k == "iban"]
            assert got[:1] == [iban] and len(got) == 1 + after.startswith(" BE68"), (t, got)
    pii.find_spans("AB12 " * 80_000 + "AB12" * 80_000)


def test_long_texts_take_linear_time():
    for t in ("a" * 400_000, "1." * 200_000, "1" * 400_000, "+1 " * 100_000, "a@" * 100_000, "f" * 400_000, "token " * 60_000):
        pii.find_spans(t)
        blob_ledger.find_secrets(t)
        licenses.words_of(t)


def test_odd_rows(spark, odd_docs):
    rows = {r.doc_id: r for r in pii.detect_pii(odd_docs).collect()}
    assert rows[2].spans == [] and rows[3].spans == [] and [s.kind for s in rows[7].spans] == ["email"]
    assert pii.detect_pii(odd_docs.limit(0)).count() == 0
    lic = {r.doc_id: r for r in licenses.scan_licenses(odd_docs).collect()}
    assert lic[2].n_words == 0 and lic[9].n_words == 50_000 and lic[1].places == []
    assert licenses.scan_licenses(odd_docs.limit(0)).count() == 0


def test_ledger_scans_each_blob_once_per_rule_version(spark, odd_docs):
    ledger = blob_ledger.new_ledger(spark)
    first = blob_ledger.scan_versions(odd_docs, ledger).collect()
    assert len(first) == odd_docs.count()
    by_id = {r.doc_id: r for r in first}
    assert [s.kind for s in by_id[7].spans] == ["assign"] and by_id[2].blob == by_id[3].blob
    blobs = odd_docs.selectExpr("sha2(coalesce(text, ''), 256) b").distinct().count()
    assert blob_ledger.read_ledger(spark, ledger).count() == blobs

    def refuse(text):
        raise AssertionError("a known blob was scanned again")

    again = blob_ledger.scan_versions(odd_docs, ledger, rules=refuse).collect()
    assert sorted(map(str, again)) == sorted(map(str, first))
    more = spark.createDataFrame([(100, "token: abcdefgh99"), (101, "one")], "doc_id long, text string")
    out = {r.doc_id: r for r in blob_ledger.scan_versions(more, ledger).collect()}
    assert len(out[100].spans) == 1 and out[101].spans == []
    assert blob_ledger.read_ledger(spark, ledger).count() == blobs + 1
    blob_ledger.scan_versions(more, ledger, rule_version="rules-2", rules=lambda t: []).collect()
    assert blob_ledger.read_ledger(spark, ledger).count() == blobs + 3


def test_mask():
    assert blob_ledger.mask("abcdef", [("x", 1, 3), ("y", 2, 5)]) == "a<x>f"
    assert blob_ledger.mask(None, [("x", 0, 1)]) is None and blob_ledger.mask("abc", []) == "abc"


def test_licences(spark, small_docs):
    got = {r.doc_id: r for r in QUERIES["op5_licenses"](spark, SF_SMALL).collect()}
    assert len(got) == len(small_docs)
    for doc_id, text, _, _ in small_docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, lab) for p, lab in licenses.PHRASES.items() for i in range(len(words))
                  if words[i:i + len(p.split())] == p.split()]
        r = got[doc_id]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min(places)[0] if places else None, max(places)[0] if places else None)
        assert r.base_labels == ",".join(sorted({lab for _, lab in places}))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


def test_licence_index_needs_position_and_key_phrase():
    ix = licenses.Index({w: 50 for w in "the of this and".split()}, 1000)
    notice = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
              " documentation files")
    words = licenses.words_of("some words before " + notice)
    assert [(m[0], m[1]) for m in ix.match(words)] == [("mit", 3)]
    shuffled = words[:]
    random.Random(3).shuffle(shuffled)
    assert ix.match(shuffled) == []
    assert ("cc-by-nc", 1) in [(m[0], m[1]) for m in ix.match(licenses.words_of("x Licensed under CC BY-NC 4.0."))]
    assert ix.match([]) == []
