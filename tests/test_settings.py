import pytest

from tidemark.plans import notify, settings
from tidemark.streaming import control


def test_settings(tmp_path):
    s = settings.load({"mysql": {"port": 1, "nonsense": 2}, "migration": {"cdc": {"raw_events_max": 0}}}, {"MYSQL_PORT": "x", "CDC_SNAPSHOT_BEFORE": "no", "CDC_FORCE_BINLOG_POSITION": "", "NOTIFICATIONS_RATE_LIMIT_SECONDS": "0"})
    assert s.mysql.port == 1 and not s.migration.cdc.snapshot_before and s.migration.cdc.force_binlog_position is None
    assert s.notifications.rate_limit_seconds == 0 and s.migration.cdc.files_per_batch is None
    state = settings.State(str(tmp_path / "x" / "s.json"))
    state.set_position("bin.1", 4)
    state.progress("t", 5, last_pk=9)
    state.progress("t", 2, done=True)
    assert state.table("t") == {"status": "done", "last_pk": 9, "rows_processed": 7}
    (tmp_path / "x" / "s.json").write_text("{")
    assert state.get() == {"binlog": None, "gtid": None, "tables": {}}


def test_notices():
    sent = []

    def send(url, payload):
        sent.append((url, payload))
        return (200, "ok") if "slack" in url else (200, '{"ok": true}')

    s = settings.load({"notifications": {"enabled": True, "slack": {"webhook_url": "http://slack"}, "telegram": {"bot_token": "t", "chat_id": 1}}}, {}).notifications
    d = notify.from_settings(s, "dev", send)
    try:
        control.parse_position("nowhere")
    except ValueError as e:
        assert d.error("apply", "t", "a <b> text", {"k": "v" * 9000}, e)
    assert not d.error("apply", "t", "again") and d.info("copy", "other topics go on")
    assert "[dev]" in sent[0][1]["text"] and "&lt;b&gt;" in sent[1][1]["text"] and len(sent[1][1]["text"]) <= notify.TELEGRAM_TEXT
    assert "tidemark.streaming.control:" in sent[1][1]["text"]
    assert notify.from_settings(settings.Notifications()) is None
    many = notify.slack_blocks(notify.Layout(notify.Notice("t" * 200, "x", facts={str(i): i for i in range(20)})))
    blocks = many["attachments"][0]["blocks"]
    assert len(blocks[0]["text"]["text"]) == notify.SLACK_HEADING and len(blocks[-1]["fields"]) == notify.SLACK_FIELDS
    card = notify.adaptive_card(notify.Layout(notify.Notice("x", "y", notify.WARNING, {"a": 1})))["attachments"][0]["content"]
    assert card["type"] == "AdaptiveCard" and card["body"][-1]["facts"][0] == {"title": "a", "value": "1"}


def test_a_service_that_fails_does_not_stop_the_others():
    def send(url, payload):
        if url == "bad":
            raise OSError("no route")
        return 200, "ok"

    now = [0.0]
    d = notify.Dispatcher([notify.slack("bad"), notify.slack("good")], 60, send=send, clock=lambda: now[0])
    assert d.info("x", "y") and not d.info("x", "y")
    now[0] = 61
    assert d.info("x", "y")
    assert not notify.Dispatcher([notify.telegram("t", 1)], 0, send=lambda *_: (200, "[]")).info("x", "y")


def test_control():
    assert control.parse_position("bin.1:20") == ("bin.1", 20)
    with pytest.raises(ValueError):
        control.parse_position("bin.1")
    assert control.start_position(None, None, ("a", 1), ("b", 2)) == ("a", 1)
