"""Regions against a worklist of whole texts; mixed encodings; content too long to hold."""

import base64
import bz2
import gzip
import hashlib
import lzma
import os
import random
import time
import urllib.parse

import numpy as np
import pytest

from larkspur.llm import secret_scan

SECRETS = ["password=hunter2abc", 'token : "abcdef123456"', "AKIA" + "ABCDEFGH12345678", "0123456789abcdef01234567", "api_key=zzzzzz999"]


def whole_texts(text):
    """The same decoders on whole layers: every order of them, each layer scanned as a text."""
    found, met = set(), {hashlib.sha256(text.encode()).digest()}
    identity = np.arange(len(text) + 1)
    work = [(text, identity[:-1], identity[1:])]
    while work:
        layer = work.pop()
        for pattern, decode in secret_scan.DECODERS:
            new = secret_scan._unwrap(*layer, pattern, decode, found)
            if new is not None and (key := hashlib.sha256(new[0].encode(errors="surrogatepass")).digest()) not in met:
                met.add(key)
                work.append(new)
                found.update((int(new[1][a]), k, int(new[2][z - 1])) for a, k, z in secret_scan.scan(new[0]))
    return found


def percent(s):
    return "".join(f"%{b:02X}" for b in s.encode())


def unicode(s):
    return "".join(f"\\u{ord(c):04x}" for c in s)


def b64(s):
    return base64.b64encode(s.encode() if isinstance(s, str) else s).decode()


ENCODERS = [percent, unicode, b64, urllib.parse.quote, lambda s: b64(gzip.compress(s.encode(), mtime=0)),
            lambda s: "".join(f"&#{ord(c)};" for c in s)]


def piece(rng):
    s = rng.choice(SECRETS)
    if rng.random() < 0.3:                                   # only its value is encoded, next to a plain key
        s = rng.choice(["password=", "secret: ", 'token = "', "x "]) + rng.choice(ENCODERS[:4])("valuevalue" + str(rng.random()))
    for _ in range(rng.randrange(3)):
        s = rng.choice(ENCODERS)(s)
    return s


@pytest.mark.parametrize("seed", range(6))
def test_regions_find_what_whole_texts_find(seed):
    rng = random.Random(seed)
    for _ in range(40):
        joins = [" ", "\n", ", ", "; ", " plain words here ", "\t", "=", ":", ": ", " = ", "(", '"']
        text = "".join(piece(rng) + rng.choice(joins) for _ in range(rng.randrange(1, 4)))
        base = set(secret_scan.scan(text))
        assert secret_scan.layered_spans(text) | base == whole_texts(text) | base, text


def test_encodings_of_different_regions_do_not_multiply():
    def text(k):
        out = []
        for encode in (percent, unicode, b64):
            s = SECRETS[0]
            for _ in range(k):
                s = encode(s)
                if len(s) > 3000:
                    break
            out.append(s)
        return ", some text, ".join(out * 3)
    calls = []
    real = secret_scan._unwrap
    try:
        secret_scan._unwrap = lambda *a: calls.append(len(a[0])) or real(*a)
        work = []
        for k in (1, 2, 3):
            calls.clear()
            assert len(secret_scan.layered_spans(text(k))) >= 6
            work.append(sum(calls) / len(text(k)))
    finally:
        secret_scan._unwrap = real
    assert work[2] < 6 * work[0]                             # (k + 1) ** 9 whole-text layers would be thousands


def test_a_long_text_takes_time_in_proportion():
    took = []
    for n in (20_000, 80_000):
        text = " ".join(f"word{i} {b64(f'plain text number {i}')}, %41%42" for i in range(n // 40))
        began = time.perf_counter()
        secret_scan.layered_spans(text)
        took.append(time.perf_counter() - began)
    assert took[1] < 10 * took[0] + 0.5


@pytest.mark.parametrize("pack", [gzip.compress, bz2.compress, lzma.compress, lambda d: gzip.compress(bz2.compress(d)),
                                  lambda d: gzip.compress(d[:1000]) + gzip.compress(d[1000:])])
def test_content_too_long_to_hold_is_scanned_in_windows(monkeypatch, pack):
    monkeypatch.setattr(secret_scan, "MOST_DECOMPRESSED", 50_000)
    monkeypatch.setattr(secret_scan, "STREAM_WINDOW", 20_000)
    monkeypatch.setattr(secret_scan, "STREAM_OVERLAP", 2_000)
    rng = random.Random(1)
    words = " ".join("".join(rng.choices("ghijklm", k=7)) for _ in range(40_000))
    for at in (0, 19_990, 150_000, len(words)):
        for secret, kind in ((SECRETS[0], 0), (SECRETS[3], 2), (b64(SECRETS[0]), 0)):
            data = f"{words[:at]} {secret} {words[at:]}".encode()
            text = f"x {b64(pack(data))} y"
            assert {k for a, k, z in secret_scan.layered_spans(text) if (a, z) == (2, len(text) - 2)} == {kind}
    assert secret_scan.layered_spans(f"x {b64(pack(words.encode()))} y") == set()
    assert secret_scan.layered_spans(f"x {b64(pack(os.urandom(200_000)))[:2000]} y") is not None
