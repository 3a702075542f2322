"""The three golden clip lists (padding 1000 / 5000 / 0 ms, time_seek honoured)."""

import pytest

from annolake.operators.intervals import clip_list

GOLDEN = {
    1000: [("recording_1.wav", 0, 39000), ("recording_1.wav", 41000, 61000), ("recording_2.wav", 19000, 51000)],
    5000: [("recording_1.wav", 0, 62000), ("recording_2.wav", 15000, 52000)],
    0: [("recording_1.wav", 0, 38000), ("recording_1.wav", 42000, 60000), ("recording_2.wav", 20000, 50000)],
}


@pytest.mark.parametrize("padding", sorted(GOLDEN))
@pytest.mark.parametrize("chunk", [3_600_000, 7_000, 1_000])
def test_clip_list_golden(spark, recordings, annotations, padding, chunk):
    clips = clip_list(annotations, recordings, pad_ms=padding, chunk=chunk)
    got = sorted((r.recording_filename, r.start, r.end) for r in clips.collect())
    assert got == GOLDEN[padding]


def test_clip_names(spark, recordings, annotations):
    clips = clip_list(annotations, recordings, pad_ms=0)
    names = sorted(r.clip_filename for r in clips.collect())
    assert names == ["recording_1-0to38000.wav", "recording_1-42000to60000.wav", "recording_2-20000to50000.wav"]
