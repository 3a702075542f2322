"""Pieces of generated WAV files against the ``wave`` module."""

import io
import random
import struct
import wave

import pytest

from annolake.operators.audio import cut_wav, read_recordings, write_pieces


def wav(seed, rate, channels, width, frames, extra=b""):
    rng = random.Random(seed)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(width)
        w.setframerate(rate)
        w.writeframes(rng.randbytes(frames * channels * width))
    raw = out.getvalue()
    return raw[:4] + struct.pack("<I", len(raw) - 8 + len(extra)) + raw[8:12] + extra + raw[12:]


FILES = {"a/r1.wav": wav(1, 8000, 1, 2, 16_000), "r2.wav": wav(2, 44_100, 2, 2, 50_000, b"LIST" + struct.pack("<I", 5) + b"hello\0"),
         "r3.wav": wav(3, 11_025, 1, 1, 9999, b"note\2\0\0\0ab" * 40), "r4.wav": wav(4, 8000, 1, 2, 0)}
CLIPS = [("a/r1.wav", 0, 500), ("a/r1.wav", 501, 1999), ("a/r1.wav", 1900, 99_999), ("a/r1.wav", 5000, 6000), ("r2.wav", 33, 777), ("r2.wav", 1000, 1001),
         ("r3.wav", 7, 100), ("r3.wav", 123, 900), ("r4.wav", 0, 10), ("nowhere.wav", 0, 9), ("a/r1.wav", 0, 500)]


def brute(raw, start, end):
    with wave.open(io.BytesIO(raw)) as w:
        first, last = (min(x * w.getframerate() // 1000, w.getnframes()) for x in (start, end))
        w.setpos(first)
        return w.getparams()[:3], w.readframes(last - first)


def opened(raw):
    with wave.open(io.BytesIO(raw)) as w:
        return w.getparams()[:3], w.readframes(w.getnframes())


@pytest.fixture
def clips(spark):
    return spark.createDataFrame(CLIPS, "recording_filename string, start long, end long")


def test_pieces_equal_a_brute_force_cut(spark, clips):
    files = spark.createDataFrame([(k, bytearray(v)) for k, v in FILES.items()], "recording_filename string, content binary")
    pieces, bad = cut_wav(files, clips)
    got = {(r.recording_filename, r.clip_start, r.clip_end): (r.output, bytes(r.content)) for r in pieces.collect()}
    want = {c: brute(FILES[c[0]], c[1], c[2]) for c in CLIPS if c[0] in FILES}
    assert got.keys() == want.keys() and bad.count() == 0
    for k, (name, raw) in got.items():
        assert opened(raw) == want[k] and name == f"{k[0][:-4]}-{k[1]}to{k[2]}.wav"
        assert len(raw) % 2 == 0 and struct.unpack("<I", raw[4:8])[0] == len(raw) - 8


def test_broken_files(spark, clips):
    r1 = FILES["a/r1.wav"]
    broken = {"a/r1.wav": r1[:20_001], "r2.wav": b"RIFF....WAVE", "r3.wav": b"not a recording at all, but long enough for a header", "r4.wav": None}
    files = spark.createDataFrame([(k, None if v is None else bytearray(v)) for k, v in broken.items()], "recording_filename string, content binary")
    pieces, bad = cut_wav(files, clips)
    assert sorted(r.recording_filename for r in bad.collect()) == ["r2.wav", "r3.wav", "r4.wav"]
    # an interrupted recording ends where the file does
    cut = {r.clip_start: bytes(r.content) for r in pieces.collect()}
    assert opened(cut[0])[1] == r1[44:44 + 8000] and opened(cut[501])[1] == r1[44 + 8016:20_000]


def test_from_files_to_files_with_some_there_already(spark, clips, tmp_path):
    for name, raw in FILES.items():
        path = tmp_path / "in" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(raw)
    there = spark.createDataFrame([("r2-33to777.wav",)], "output string")
    pieces, _ = cut_wav(read_recordings(spark, str(tmp_path / "in")), clips, existing=there)
    for _ in range(2):
        done = {r.output: r.n_bytes for r in write_pieces(pieces, str(tmp_path / "out")).collect()}
    assert "r2-33to777.wav" not in done and len(done) == 8
    for name, n in done.items():
        raw = (tmp_path / "out" / name).read_bytes()
        assert len(raw) == n
    assert not list((tmp_path / "out").rglob("*.part"))
    assert opened((tmp_path / "out" / "a/r1-0to500.wav").read_bytes()) == brute(FILES["a/r1.wav"], 0, 500)


def test_layout_is_native(spark, clips):
    files = spark.createDataFrame([("r", bytearray(b""))], "recording_filename string, content binary")
    plan = cut_wav(files, clips)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
