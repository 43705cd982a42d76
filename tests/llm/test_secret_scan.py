import base64
import gzip
import hashlib
import re
import urllib.parse
import zlib

import pytest

from millrace.llm import secret_scan
from millrace.llm.secret_scan import KINDS, scan

SECRET = 'password = "abcdefghijklmnop"'
B64 = base64.b64encode(SECRET.encode()).decode()


def found(text):
    return [(KINDS[k], text[a:b], d) for a, k, b, d in scan(text)[0]]


@pytest.mark.parametrize("text,depth", [
    (SECRET, 0),
    (B64, 1),
    (urllib.parse.quote(SECRET, safe=""), 1),
    ("".join(f"\\u{ord(c):04x}" for c in SECRET), 1),
    ("".join(f"&#{ord(c)};" for c in SECRET), 1),
    (base64.b64encode(gzip.compress(SECRET.encode())).decode(), 1),
    (base64.b64encode(zlib.compress(SECRET.encode())).decode(), 1),
    (base64.b64encode(B64.encode()).decode(), 2),
    (urllib.parse.quote(urllib.parse.quote(SECRET, safe=""), safe=""), 2),
    (urllib.parse.quote(base64.b64encode(gzip.compress(B64.encode())).decode(), safe=""), None),
])
def test_layers(text, depth):
    got = found(f"é x {text} tail")
    assert [k for k, _, d in got if depth is None or d == depth] == ["assign"]
    assert all(span in text for _, span, _ in got)


def test_spans_map_to_the_original():
    text = "ab %70assword%3A abcdefghijkl"
    assert [(text[a:b], d) for a, _, b, d in scan(text)[0]] == [("%70assword%3A abcdefghijkl", 1)]


def wrapped(text, width=76):
    return "\n".join(text[i : i + width] for i in range(0, len(text), width))


@pytest.mark.parametrize("text", [
    base64.b64encode(gzip.compress(b"first member, no secret ") + gzip.compress(SECRET.encode())).decode(),
    wrapped(base64.b64encode(gzip.compress(hashlib.sha512(b"x").hexdigest().upper().encode() + b" " + SECRET.encode())).decode()),
    wrapped(base64.b64encode(b"a line of words before it, so that it breaks " + SECRET.encode()).decode(), 64),
    f"blob-{B64}", f"x_{B64}", f"/files/v1/{B64}", f"xyz{B64}",
])
def test_members_wrapped_lines_and_prefixes(text):
    got = found(f"see {text} tail")
    assert [(k, d) for k, _, d in got] == [("assign", 1)]
    assert all(span in text for _, span, _ in got)


def test_lines_that_do_not_belong_together():
    noise = "abcdefghijklmnopq"  # not a multiple of four
    assert [k for k, _, d in found(f"{noise}\n{B64}") if d == 1] == ["assign"]


def test_base_rules():
    assert found("token = token=\"abcdefghijklmnop\"") == []  # the short match takes the place of the long one
    assert found("toKen=abcdefghijkl paſswd=abcdefghijkl") == []  # only ASCII letters have two cases
    assert found("AKIAABCDEFGHIJKLM1 AKIA12") == [("access", "AKIAABCDEFGHIJKLM1", 0)]
    assert [k for k, _, _ in found("API_KEY: 0123456789abcdef")] == ["assign", "hex"]


def test_cycles_and_bombs_end(monkeypatch):
    assert scan("%25" * 400 + "%2525")[1] == 0
    monkeypatch.setattr(secret_scan, "INFLATED", 1000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 100)
    bomb = base64.b64encode(zlib.compress(b"z" * 100_000)).decode()
    assert scan(f"x {bomb}") == ([], 0)
    # A secret at any place of a large stream is found, also over a bound of two windows and behind a member's end.
    for at in (0, 990, 1090, 1095, 5000, 99_000):
        data = b"." * at + b" " + SECRET.encode() + b" " + b"." * (100_000 - at)
        for stream in (gzip.compress(data), gzip.compress(data[:1050]) + gzip.compress(data[1050:]), gzip.compress(b"\x00\xff" + data)):
            chars = base64.b64encode(stream).decode()
            assert scan(f"x {chars}") == ([(2, 0, 2 + len(chars.rstrip("=")) + chars.count("="), 1)], 0), at
    twice = base64.b64encode(gzip.compress(gzip.compress(bytes(range(256)) * 400, 0))).decode()
    assert scan(f"x {twice}") == ([], 1)


def test_secrets_in_mixed_payloads():
    secret = "token=abcdefghijkl1234"
    raw = secret.encode()
    mixed = [
        b"x\x00 " + raw, b"\x1b[0m" + raw, raw + b"\xff", b"\xff\xfe" + secret.encode("utf-16-le"), secret.encode("utf-16-be"),
        b"\x00" + secret.encode("utf-16-le"), b"\x89PNG\x00\x01" + raw + b"\x00" * 9, b"\xe9\x00" * 50 + raw,
    ]
    for data in mixed:
        for lead in ("", "a-", "ab_", "abc/"):
            text = f"é see {lead}{base64.b64encode(data).decode()} tail"
            spans = [(a, b) for a, kind, b, depth in scan(text)[0] if kind == 0 and depth == 1]
            first = data.find(raw)
            if first >= 0:
                start = 6 + len(lead) + first * 4 // 3
                assert spans == [(start, 6 + len(lead) + ((first + len(raw)) * 4 + 2) // 3)], (data, lead)
            else:
                assert len(spans) == 1 and text[spans[0][0] : spans[0][1]] in text, (data, lead)
        packed = base64.b64encode(gzip.compress(b"\x00\x01" + data)).decode()
        assert [k for _, k, _, _ in scan(f"x {packed}")[0]] == [0]


def test_random_nesting():
    """Layers nested at random around a secret: the finding covers the place of the whole encoded part or lies in it."""
    import random

    rng = random.Random(5)
    steps = {
        "base64": lambda s: base64.b64encode(s.encode()).decode(),
        "mixed": lambda s: base64.b64encode(b"\x00\x01\xff" + s.encode() + b"\xfe").decode(),
        "gzip": lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
        "percent": lambda s: "".join(f"%{b:02x}" for b in s.encode()),
        "unicode": lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        "reference": lambda s: "".join(f"&#x{ord(c):x};" for c in s),
        "context": lambda s: f"é {s} ü",
    }
    for _ in range(150):
        inner, chosen = SECRET, []
        for _level in range(rng.randint(1, 4)):
            chosen.append(rng.choice(list(steps)))
            inner = steps[chosen[-1]](inner)
            if len(inner) > 40_000:
                break
        text = f"é before {inner} after"
        spans = [(a, b) for a, kind, b, _ in scan(text)[0] if kind == 0]
        assert spans and all(9 <= a < b <= 9 + len(inner) for a, b in spans), chosen


def test_query_against_plain_matching(spark, sf_dir):
    from millrace.llm.queries import QUERIES
    from millrace.llm.texts import table

    rules = [
        ("assign", r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16),
    ]
    texts = {r.doc_id: r.text or "" for r in table(spark, sf_dir, "documents").collect()}
    got = {r.doc_id: r for r in QUERIES["op4_secrets"](spark, sf_dir).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        spans = []
        for at, (kind, pattern, group, least) in enumerate(rules):
            spans += [(m.start(), at, kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
        base = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        row = got[doc_id]
        assert row.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert [row.n_assign, row.n_access, row.n_hex] == [sum(s[2] == k for s in spans) for k in KINDS]
        assert set(filter(None, base.split(","))) <= set(row.spans.split(","))


def test_null_empty_repeats_and_clashing(files):
    rows = files([(None, None, 1), (1, "", 2), (2, SECRET, 3), (2, SECRET, 3)], "doc_id long, text string, secrets int")
    got = secret_scan.find_secrets(rows).collect()
    assert sorted(len(r.secrets) for r in got) == [0, 0, 1, 1]
    assert secret_scan.digests(rows.limit(0)).count() == 0


def test_spans_behind_malformed_escapes():
    secret = "token=abcdefghijkl1234"
    coded = "".join(f"%{b:02X}" for b in secret.encode())
    for prefix in ("%E2%82", "%EF%BF%BD", "%F0%9F%98", "%41", "%FF", "%FF%FE", "%C3%A9", "%ED%A0%80", ""):
        spans, _ = secret_scan.scan(f"zz {prefix}{coded} end")
        start = 3 + len(prefix)
        assert [(a, b) for a, kind, b, _ in spans if kind == 0] == [(start, start + len(coded))], prefix
    long = "%FF" * 200_000 + coded
    assert secret_scan.scan(long)[0][0][:3] == (600_000, 0, 600_000 + len(coded))
    for data in (b"\xe2\x82a", b"\xf0\x9f\x98", b"\xff\xef\xbf\xbdz", "\ufffd\u00e9".encode()):
        found = secret_scan.read_bytes(data)
        assert "".join(c for c, _, _ in found) == data.decode("utf-8", "replace")
        assert [a for _, a, _ in found] == [0, *(b for _, _, b in found)][:-1] and found[-1][2] == len(data)
