"""Layers that are not plain printable UTF-8, several streams, and base64 over several lines."""

import base64
import bz2
import gzip
import io
import lzma
import tarfile
import textwrap

import pytest

from larkspur.llm import secret_scan

SECRET = 'password = "hunter2abc"'
ODD = ["\u00a0", "\u3000", "\u200b", "\u200d", "\ufeff", "\u00ad", "\f", "\0"]


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


def tar(text):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for name, data in (("a.bin", bytes(range(256)) * 3), ("b.txt", text.encode())):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


LAYERS = ([f"é{c} {SECRET} 中" for c in ODD] + [SECRET.encode("utf-16"), f"é {SECRET}".encode("utf-16-le"), SECRET.encode("utf-16-be"), f"été {SECRET}".encode("latin-1"),
          gzip.compress(f"x{ODD[0]}{SECRET}".encode()), gzip.compress(tar(SECRET)), lzma.compress(tar(b64(SECRET))), tar(SECRET),
          gzip.compress(b"first text") + gzip.compress(SECRET.encode()), bz2.compress(b"first text") + bz2.compress(SECRET.encode()),
          lzma.compress(b"first text") + lzma.compress(SECRET.encode()), gzip.compress(bz2.compress(SECRET.encode())), b64(f"\ufeff{SECRET}")])


@pytest.mark.parametrize("layer", range(len(LAYERS)))
def test_secret_in_a_layer_is_found(layer):
    piece = b64(LAYERS[layer])
    text = f"x {piece} y"
    spans = secret_scan.layered_spans(text)
    assert any(k == 0 and 2 <= a < z <= 2 + len(piece) for a, k, z in spans)


@pytest.mark.parametrize("width", [16, 60, 64, 76])
@pytest.mark.parametrize("data", [f"a long é text {'of many words ' * 9}{SECRET} and more", gzip.compress(f"{SECRET} {list(range(90))}".encode())])
def test_base64_over_lines(width, data):
    lines = textwrap.wrap(b64(data), width)
    for end, indent in (("\n", ""), ("\r\n", "  ")):
        for before, after in (("", ""), ("internationalization\n", "\nand text"), ("data: ", ""), ("", "\nThanks")):
            text = before + (end + indent).join(lines) + after
            found = [(a, z) for a, k, z in secret_scan.layered_spans(text) if k == 0]
            assert found, (before, after)
            assert all(len(before) <= a < z <= len(text) - len(after) + 3 for a, z in found)
    if isinstance(data, str):
        piece = "\n".join(lines)
        a, _, z = next(x for x in secret_scan.layered_spans(piece) if x[1] == 0)
        inside = piece[a:z].replace("\n", "")
        assert len(SECRET) < len(inside) <= len(SECRET) * 4 / 3 + 4
