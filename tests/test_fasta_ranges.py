"""FASTA by ranges against whole records."""

import gzip
import random
import struct
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from fraclake.sources import fasta_ranges
from fraclake.sources.fasta_ranges import _pieces, _state, packing, read_fasta_ranges


def some_fasta(seed, records=12):
    r = random.Random(seed)
    out = []
    for i in range(records):
        seq = "".join(r.choice("acgtN") for _ in range(r.choice((0, 1, 3, 40, 200))))
        width, end = r.choice((5, 17, 1000)), r.choice(("\n", "\r\n"))
        body = end.join(seq[at:at + width] for at in range(0, len(seq), width))
        out.append(f">r{i} a > b{'x' * r.choice((0, 30))}{end}{body}{end if body else ''}" + ("\n" if r.random() < 0.2 else ""))
    text = "".join(out)
    return (text if seed % 3 else text.rstrip("\r\n")).encode()


def windows(data, k):
    found = Counter()
    for record in ("\n" + data.decode().replace("\r", "")).split("\n>"):
        seq = "".join(record.split("\n")[1:]).upper() if record else ""
        found.update(seq[i:i + k] for i in range(len(seq) - k + 1))
    return found


def blocks(data, size=50):
    """Block-compressed gzip."""
    out = b""
    for part in [data[at:at + size] for at in range(0, len(data), size)] + [b""]:
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(part) + packer.flush()
        head = b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", 6) + b"BC\x02\x00" + struct.pack("<H", len(body) + 25)
        out += head + body + struct.pack("<II", zlib.crc32(part), len(part))
    return out


@pytest.mark.parametrize("k", [1, 2, 5, 31])
@pytest.mark.parametrize("packed", ["no", "blocks", "whole"])
def test_ranges_hold_every_window_once(monkeypatch, k, packed):
    monkeypatch.setattr(fasta_ranges, "READ", 37)
    monkeypatch.setattr(fasta_ranges, "ROW", 11)
    for seed in range(12):
        data = some_fasta(seed)
        raw = {"no": data, "blocks": blocks(data), "whole": gzip.compress(data[:100]) + gzip.compress(data[100:])}[packed]
        for size in (1, 7, 64, 300, 10**6) if packed != "whole" else (len(raw),):
            file, found, state = pa.BufferReader(raw), Counter(), None
            for lo in range(0, len(raw), size):
                hi = min(lo + size, len(raw))
                header = state == "header" if state else data[:1] == b">"
                for row in _pieces(file, packed, lo, hi, header, k):
                    assert len(row) <= 11 + k - 1 or packed
                    found.update(row[i:i + k].decode() for i in range(len(row) - k + 1))
                state = _state(file, packed, lo, hi) or state if packed != "whole" else None
            assert found == windows(data, k), (seed, size)


def test_files_of_every_packing(spark, tmp_path):
    data = b"".join(some_fasta(seed) + b"\n" for seed in range(1, 30))
    long = b">one line\n" + bytes(random.Random(3).choices(b"ACGT", k=100_000))
    (tmp_path / "sub").mkdir()
    files = {"plain.fa": data, "sub/blocks.fa.gz": blocks(data, 2000), "whole.fa.gz": gzip.compress(data), "long.fa": long, "empty.fa": b"", "no.fa": b"ACGTACGT"}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    assert [packing(str(tmp_path / n)) for n in ("plain.fa", "sub/blocks.fa.gz", "whole.fa.gz")] == ["no", "blocks", "whole"]
    rows = read_fasta_ranges(spark, str(tmp_path), 21, size=3000).collect()
    found = {}
    for r in rows:
        found.setdefault(r.path.rsplit("/", 1)[1], Counter()).update(r.seq[i:i + 21] for i in range(len(r.seq) - 20))
    assert found["plain.fa"] == found["blocks.fa.gz"] == found["whole.fa.gz"] == windows(data, 21)
    assert found["long.fa"] == windows(long, 21) and "no.fa" not in found
    assert len({r.offset for r in rows if r.path.endswith("long.fa")}) == 34
