"""Growing log files, read once each line: between batches, after restarts, across rotations."""

import os
import shutil

import pytest

from touchline.session import scratch_path
from touchline.sources.logtail import LogTailReader, follow_app_logs, local_path
from touchline.streaming import job

NOW = {"availableNow": True}


def append(folder, name, text):
    with open(f"{folder}/{name}", "ab") as f:
        f.write(text if isinstance(text, bytes) else text.encode())


class Tail:
    """A query over a folder; each call of ``more`` runs what is new and returns its lines."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, str(folder), {"settleSeconds": 0} | options
        self.checkpoint, self.seen = scratch_path(spark, "checkpoint"), []

    def more(self):
        new = []
        sink = lambda df, _: new.extend((r.file, r.position, r.value) for r in df.collect())
        query = job.start(follow_app_logs(self.spark, self.folder, **self.options), sink, self.checkpoint, NOW)
        query.awaitTermination()
        self.seen += new
        return sorted(new)


def test_lines_come_once_between_batches_and_restarts(spark, tmp_path):
    tail = Tail(spark, tmp_path)
    append(tmp_path, "app.log", "a\nb\npart")
    assert tail.more() == [("app.log", 0, "a"), ("app.log", 2, "b")]
    assert tail.more() == []
    append(tmp_path, "app.log", "ly\r\n\n")
    append(tmp_path, "other.log", "é\n\xff".encode("latin-1") + b"\n")
    assert tail.more() == [("app.log", 4, "partly"), ("app.log", 12, ""), ("other.log", 0, "�"), ("other.log", 2, "�")]
    assert tail.more() == []


def test_rotated_file_is_finished_under_its_new_name(spark, tmp_path):
    tail = Tail(spark, tmp_path)
    append(tmp_path, "app.log", "a\n")
    assert [v for *_, v in tail.more()] == ["a"]
    append(tmp_path, "app.log", "b\nlast without newline")
    os.rename(tmp_path / "app.log", tmp_path / "app.log.1")
    append(tmp_path, "app.log", "c\n")
    assert tail.more() == [("app.log", 0, "c"), ("app.log.1", 2, "b"), ("app.log.1", 4, "last without newline")]
    os.rename(tmp_path / "app.log.1", tmp_path / "app.log.2")
    append(tmp_path, "app.log", "d\n")
    assert tail.more() == [("app.log", 2, "d")]
    os.remove(tmp_path / "app.log.2")
    assert tail.more() == []


def test_unsettled_rotated_file_waits_for_its_newline(spark, tmp_path):
    tail = Tail(spark, tmp_path, settleSeconds=3600)
    append(tmp_path, "app.log.1", "a\nopen")
    assert [v for *_, v in tail.more()] == ["a"]
    append(tmp_path, "app.log.1", "ed\n")
    assert [v for *_, v in tail.more()] == ["opened"]


def test_only_new_lines(spark, tmp_path):
    tail = Tail(spark, tmp_path, from_start=False)
    append(tmp_path, "app.log", "old\nolder\n")
    assert tail.more() == []
    append(tmp_path, "app.log", "new\n")
    append(tmp_path, "later.log", "all of it\n")
    assert [v for *_, v in tail.more()] == ["new", "all of it"]


def test_folder_that_comes_later(spark, tmp_path):
    folder = tmp_path / "logs"
    tail = Tail(spark, folder)
    assert tail.more() == []
    folder.mkdir()
    append(folder, "app.log", "x\n")
    append(folder, "notes.txt", "y\n")
    assert tail.more() == [("app.log", 0, "x")]


def test_cut_file_starts_again(spark, tmp_path):
    tail = Tail(spark, tmp_path)
    append(tmp_path, "app.log", "one\ntwo\nthree\n")
    tail.more()
    with open(tmp_path / "app.log", "wb") as f:
        f.write(b"four\n")
    assert tail.more() == [("app.log", 0, "four")]


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 64])
def test_pieces_share_no_line(spark, tmp_path, piece):
    """Cuts at every kind of place: inside lines, at their ends, and between empty ones."""
    lines = ["", "a", "", "bc", "def", "", "", "ghijklmnop", "q"]
    append(tmp_path, "app.log", "\n".join(lines) + "\n")
    tail = Tail(spark, tmp_path, pieceBytes=piece)
    found = tail.more()
    assert [v for *_, v in found] == lines
    assert [p for _, p, _ in found] == [sum(len(x) + 1 for x in lines[:i]) for i in range(len(lines))]


def test_failed_batch_is_read_again_with_the_same_lines(spark, tmp_path):
    """The batch is planned, fails, and meets a longer file when it is repeated."""
    tail = Tail(spark, tmp_path)
    append(tmp_path, "app.log", "a\nb\n")

    def broken(df, batch_id):
        raise ValueError("no sink")

    query = job.start(follow_app_logs(spark, str(tmp_path), settleSeconds=0), broken, tail.checkpoint, NOW)
    with pytest.raises(Exception, match="no sink"):
        query.awaitTermination()
    append(tmp_path, "app.log", "c\n")
    os.rename(tmp_path / "app.log", tmp_path / "app.log.1")
    tail.more()
    tail.more()
    assert [v for *_, v in tail.seen] == ["a", "b", "c"]


def test_lost_lines_fail_unless_allowed(tmp_path):
    append(tmp_path, "app.log", "a\n")
    for strict in ("true", "false"):
        reader = LogTailReader({"path": str(tmp_path), "failOnDataLoss": strict})
        (piece,) = reader.partitions(reader.initialOffset(), {"files": {"0-0": {"name": "app.log", "at": 2}}, "skip": False})
        if strict == "true":
            with pytest.raises(FileNotFoundError):
                list(reader.read(piece))
        else:
            assert list(reader.read(piece)) == []


def test_long_line_at_the_end_is_looked_for_from_behind(tmp_path):
    append(tmp_path, "app.log", "a\n" + "x" * 300_000)
    reader = LogTailReader({"path": f"file://{tmp_path}"})
    ((_, state),) = reader.latestOffset()["files"].items()
    assert state == {"name": "app.log", "at": 2}
    append(tmp_path, "app.log", "\n")
    ((_, state),) = reader.latestOffset()["files"].items()
    assert state["at"] == 300_003


def test_paths():
    assert local_path("file:///a/b") == local_path("file:/a/b") == local_path("/a/b") == "/a/b"


def test_job_ships_followed_lines(spark, tmp_path):
    """From a growing file to the audit topic, with a restart in between."""
    from touchline.sinks.messages import MessageTarget
    from touchline.sources.stream import config_from_env
    from touchline.vocabulary import TOPIC_AUDIT

    logs, target = tmp_path / "logs", MessageTarget(folder=scratch_path(spark, "topics"))
    logs.mkdir()
    config = config_from_env({
        "LOG_FILE": f"{logs}/ingestion.log", "LOG_FROM_START": "true", "TRIGGER_INTERVAL": "availableNow",
        "CHECKPOINT_LOCATION": scratch_path(spark, "checkpoint"),
    })
    for text in ("2024-01-01 00:00:00 [INFO] a.b: one\n\n", "  at line 3\n2024-01-01 00:00:01 [ERROR] a: two\n"):
        append(logs, "ingestion.log", text)
        append(logs, "unrelated.log", "no\n")
        job.run_log_tail(spark, config, target).awaitTermination()
    rows = target.read(spark, TOPIC_AUDIT).selectExpr("get_json_object(value, '$.level') AS l", "get_json_object(value, '$.message') AS m")
    assert sorted(map(tuple, rows.collect())) == [("ERROR", "two"), ("INFO", "one"), ("UNPARSED", "  at line 3")]
    shutil.rmtree(logs)
