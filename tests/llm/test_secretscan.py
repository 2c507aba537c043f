from __future__ import annotations

import base64
import hashlib
import json
import random
import re
import zlib

from ledgersieve.llm import secretscan as S

B62, B58 = S._BASE62.decode(), S._BASE58.decode()
ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain(text):
    """Base spans by whole-text expressions."""
    text, out = text or "", []
    out += [(m.start(), 0, "assign", m.end()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{k}:{a}:{b}" for a, _, k, b in sorted(out)]


def based(value, alphabet, width):
    out = ""
    while value:
        value, r = divmod(value, len(alphabet))
        out = alphabet[r] + out
    return out.rjust(width, alphabet[0])


def github(body):
    return f"ghp_{body}{based(zlib.crc32(body.encode()), B62, 6)}"


def jwt(alg="HS256"):
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    return f"{part({'alg': alg})}.{part({'sub': 'é'})}.c2ln"


def pem(n=300, claim=None):
    data = bytes([0x30, 0x82]) + (n if claim is None else claim).to_bytes(2, "big") + bytes(range(256)) * 2
    body = base64.encodebytes(data[: 4 + n]).decode()
    return f"-----BEGIN RSA PRIVATE KEY-----\n{body}-----END RSA PRIVATE KEY-----"


def xprv(seed=1):
    data = bytes.fromhex("0488ade4") + random.Random(seed).randbytes(74)
    data += hashlib.sha256(hashlib.sha256(data).digest()).digest()[:4]
    return based(int.from_bytes(data, "big"), B58, 111)


def digest(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def test_random_texts_equal_whole_text_expressions(spark, docs_of):
    draw = random.Random(5)
    bits = ["password", "PassWD", "sEcret", "token", "api_key", "APIKEY", "api__key", "AKIA", "ABCD1234EFGH", "deadbeef" * 4, "0f", "=", ":", " ", "  ", "\t", '"', "'",
            "abcdefgh", "x" * 7, "/+_.-", "é", "日", "ſecret", "toKen", "\n", "A", "9" * 31]
    texts = [(n, "".join(draw.choices(bits, k=draw.randint(0, 25)))) for n in range(600)]
    texts += [(1000, "token" * 4000 + "=abcdefgh"), (1001, "f" * 70000), (1002, "password=" * 3000), (1003, "AKIA" * 5000), (1004, "token" + " " * 30000 + "x")]
    found = {r["doc_id"]: r for r in S.secret_digests(docs_of(texts)).collect()}
    assert len(found) == len(texts)
    for i, text in texts:
        base = plain(text)
        r = found[i]
        assert r["spans"].split(",") == (base or [""]), text
        assert r["base_sha256"] == digest(base)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s.startswith(k) for s in base) for k in S.BASE]
        assert r["n_added"] == 0
    assert sum(r["n_assign"] > 0 for r in found.values()) > 50


def test_registered_query_equals_brute_force(spark):
    import __spark_entry__ as entry

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = entry.queries()["op11_secret_scan"](spark, sf).collect()
    assert len(found) == len(texts)
    for r in found:
        assert r["base_sha256"] == digest(plain(texts[r["doc_id"]]))


def test_checks_decide_over_added_kinds(spark, docs_of):
    good, body = github("a1B2" * 7 + "zz"), "a1B2" * 7 + "zz"
    bad = good[:-1] + ("A" if good[-1] != "A" else "B")
    npm = "npm_" + good[4:]
    texts = {1: (good, "github"), 2: (bad, None), 3: (npm, "npm"), 4: (npm[:-1] + "_", None), 5: (good + "x", None),
             6: (jwt(), "jwt"), 7: (jwt(alg=3), None), 8: (jwt().replace("eyJ", "eyK"), None), 9: ("eyJhbGciOiJIUzI1NiJ9.eyJ.x", None),
             10: (pem(), "pem"), 11: (pem(claim=299), None), 12: (pem().replace("PRIVATE", "PUBLIC"), None),
             13: (xprv(), "xprv"), 14: (xprv()[:-1] + ("1" if xprv()[-1] != "1" else "2"), None), 15: ("xprv" + "z" * 107, None), 16: ("ghp_" + body, None)}
    before = "日本 é "
    found = {r["doc_id"]: r for r in S.secrets(docs_of([(i, f"{before}{t} z") for i, (t, _) in texts.items()])).collect()}
    for i, (t, kind) in texts.items():
        added = [(s["kind"], s["start"], s["end"]) for s in found[i]["secret_spans"] if s["kind"] not in S.BASE]
        assert added == ([(kind, len(before), len(before) + len(t))] if kind else []), (i, t)


def test_long_keys_are_cut_whole_and_clean_texts_stay(spark, docs_of):
    long = "token = " + "k" * 5000
    texts = [(1, f"é {long} end"), (2, "a token of thanks: none"), (3, "password=abcdefgh" + "0" * 32), (4, None)]
    out = {r["doc_id"]: r for r in S.redacted(docs_of(texts)).collect()}
    assert out[1]["text"] == "é [ASSIGN] end" and out[2]["text"] == texts[1][1] and out[3]["text"] == "[ASSIGN]" and out[4]["text"] is None
    assert S.redacted(docs_of(texts)).columns == docs_of(texts).columns


def test_odd_rows(spark, odd, none):
    found = S.secret_digests(odd).collect()
    assert len(found) == odd.count()
    assert all(r["spans"] == "" and r["base_sha256"] == digest([]) for r in found)
    assert S.secret_digests(none).count() == 0
    clash = odd.withColumn("secret_spans", odd["doc_id"]).withColumn("n_hex", odd["doc_id"])
    assert S.secrets(clash).count() == odd.count() and S.secret_digests(clash).columns[0] == "doc_id"
