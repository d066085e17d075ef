"""One frame table for each finding."""

import pytest

from tickweave.operators import integrity
from tickweave.schemas import BUTTONS
from tickweave.sources import captures

HEADER = "frame,game_frame,p1_input,p2_input," + ",".join(f"{p}_{b}" for p in ("p1", "p2") for b in BUTTONS)


def _line(frame, tick, p1=1, p2=2, flip=None):
    flags = [str(m >> i & 1) for m in (p1, p2) for i in range(10)]
    if flip is not None:
        flags[flip] = str(1 - int(flags[flip]))
    return ",".join(map(str, (frame, tick, p1, p2, *flags)))


def _table(n=600, edit=None, header=HEADER):
    lines = [_line(i, i) for i in range(n)]
    for i, text in (edit or {}).items():
        lines[i] = text
    return header + "\n" + "\n".join(lines) + "\n"


CASES = {
    "clean": (_table(), []),
    "crlf": (_table().replace("\n", "\r\n"), []),
    "one_duplicate": (_table(edit={300: _line(300, 299)}), [("csv.duplicates", "warn")]),
    "exactly_one_percent": ("frame,game_frame,p1_input,p2_input\n" + "\n".join(f"{i},{min(i, 593)},1,1" for i in range(600)), [("csv.duplicates", "warn")]),
    "over_one_percent": ("frame,game_frame,p1_input,p2_input\n" + "\n".join(f"{i},{min(i, 592)},1,1" for i in range(600)), [("csv.duplicates", "error")]),
    "decreases": (_table(edit={10: _line(10, 11), 11: _line(11, 10)}), [("csv.monotonic", "error")]),
    "gap": (_table(edit={10: _line(11, 10)}), [("csv.rowcounter", "error")]),
    "no_counter": ("game_frame,p1_input,p2_input\n" + "\n".join(f"{i},1,1" for i in range(600)), [("csv.rowcounter", "warn")]),
    "legacy_no_counter": ("local_frame,p1_input,p2_input\n" + "\n".join(f"{i},1,1" for i in range(600)), []),
    "wide_mask": (_table(edit={5: _line(5, 5, p1=1024)}), [("csv.mask_range", "error"), ("csv.mask_bits", "error")]),
    "flipped": (_table(edit={5: _line(5, 5, flip=3)}), [("csv.mask_bits", "error")]),
    "p1_columns_alone": ("frame,game_frame,p1_input,p2_input," + ",".join(f"p1_{b}" for b in BUTTONS) + "\n" + "\n".join(f"{i},{i},1,{2 * (i == 7)},1" + ",0" * 9 for i in range(600)), [("csv.mask_bits", "error")]),
    "p2_columns_alone": ("frame,game_frame,p1_input,p2_input," + ",".join(f"p2_{b}" for b in BUTTONS) + "\n" + "\n".join(f"{i},{i},1,2" + ",0" * 10 for i in range(600)), []),
    "idle": ("frame,game_frame,p1_input,p2_input\n" + "\n".join(f"{i},{i},0," for i in range(600)), [("csv.inputs", "error")]),
    "one_idle": ("frame,game_frame,p1_input,p2_input\n" + "\n".join(f"{i},{i},1,0" for i in range(600)), [("csv.inputs", "warn")]),
    "starts_late": ("frame,game_frame,p1_input,p2_input\n" + "\n".join(f"{i},{i + 5},1,1" for i in range(600)), [("csv.start", "warn")]),
    "short": (_table(599), [("csv.length", "warn")]),
    "header_only": (HEADER + "\n", [("csv.rows", "error")]),
    "empty": ("", [("csv.header", "error")]),
    "no_tick": ("frame,p1_input\n0,1\n", [("csv.header", "error")]),
    "bad_mask_good_tick": (_table(edit={5: _line(5, 5).replace("5,5,1,2", "5,5,x,2")}), [("csv.parse", "error")]),
    "bad_tick": ("frame,game_frame,p1_input,p2_input\n" + "\n".join(f"{i},{i},1,1" for i in range(601)) + "\n601,oops,1,1\n", [("csv.parse", "error")]),
}


@pytest.fixture(scope="module")
def reports(spark):
    files = spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "capture string, value string")
    return {r["capture"]: r for r in integrity.reports(captures.frames(files)).collect()}


@pytest.mark.parametrize("case", CASES)
def test_findings(reports, case):
    r = reports[case]
    assert [(f["check"], f["severity"]) for f in r["findings"]] == CASES[case][1]
    assert r["ok"] == all(s != "error" for _, s in CASES[case][1])


def test_bad_rows_count_as_rows(reports):
    assert (reports["bad_mask_good_tick"]["csv_rows"], reports["bad_mask_good_tick"]["bad_rows"]) == (600, 1)
    assert (reports["bad_tick"]["csv_rows"], reports["bad_tick"]["bad_rows"]) == (601, 1)


def test_worst_duplicate_is_named(reports):
    assert "worst is frame 592 x8" in reports["over_one_percent"]["findings"][0]["detail"]


def test_videos(spark):
    files = spark.createDataFrame([(k, _table()) for k in "abcde"], "capture string, value string")
    videos = spark.createDataFrame([("a", 9, 600), ("b", 0, None), ("c", 9, None), ("d", 9, 599)], "capture string, bytes long, video_frames long")
    expected = spark.createDataFrame([(k,) for k in "abcdef"], "capture string")
    got = {r["capture"]: [f["check"] for f in r["findings"]] for r in integrity.reports(captures.frames(files), videos, expected=expected).collect()}
    assert got == {"a": [], "b": ["video.size"], "c": ["video.decode"], "d": ["video.sync"], "e": ["video.exists"], "f": ["csv.exists"]}
