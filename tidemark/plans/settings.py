"""Settings from a file and the environment, and the state document of snapshots."""

from __future__ import annotations

import json
import logging
import os
import tempfile
import threading
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass

log = logging.getLogger(__name__)

YES = ("true", "1", "yes", "on")


@dataclass
class Source:
    host: str = "127.0.0.1"
    port: int = 3306
    user: str = "root"
    password: str = ""
    database: str = ""
    include_tables: list[str] = field(default_factory=list)
    exclude_tables: list[str] = field(default_factory=list)
    ssl_ca: str | None = None
    ssl_disabled: bool = False


@dataclass
class Target:
    host: str = "127.0.0.1"
    port: int = 9000
    user: str = "default"
    password: str = ""
    database: str = ""
    secure: bool = False
    verify: bool = True
    ca_certs: str | None = None
    path: str = ""


@dataclass
class Feed:
    checkpoint_interval_rows: int = 5000
    producer_flush_interval: float = 5.0
    snapshot_before: bool = True
    force_binlog_position: str | None = None
    raw_events_max: int = 50000
    raw_events_resume_ratio: float = 0.8
    path: str = ""

    @property
    def files_per_batch(self) -> int | None:
        """The pull model's backpressure: at most so many files at once; 0 means no limit."""
        return max(1, self.raw_events_max // max(self.checkpoint_interval_rows, 1)) if self.raw_events_max > 0 else None


@dataclass
class Migration:
    mode: str = "snapshot"
    debug: bool = False
    batch_rows: int = 5000
    workers: int = 4
    clickhouse_timezone: str | None = None
    cdc: Feed = field(default_factory=Feed)


@dataclass
class Webhook:
    enabled: bool = True
    webhook_url: str = ""


@dataclass
class Chat:
    enabled: bool = True
    bot_token: str = ""
    chat_id: str = ""


@dataclass
class Notifications:
    enabled: bool = False
    webhook_url: str = ""
    rate_limit_seconds: int = 60
    teams: Webhook = field(default_factory=Webhook)
    slack: Webhook = field(default_factory=Webhook)
    telegram: Chat = field(default_factory=Chat)


@dataclass
class Settings:
    mysql: Source = field(default_factory=Source)
    clickhouse: Target = field(default_factory=Target)
    migration: Migration = field(default_factory=Migration)
    notifications: Notifications = field(default_factory=Notifications)
    state_file: str = "state.json"
    environment: str = "prod"


#: Prefixes of environment variables and the section each one sets: PREFIX_NAME sets the field `name`.
SECTIONS = {"MYSQL": "mysql", "CLICKHOUSE": "clickhouse", "MIGRATION": "migration", "CDC": "migration.cdc", "NOTIFICATIONS": "notifications", "NOTIFICATIONS_TEAMS": "notifications.teams", "NOTIFICATIONS_SLACK": "notifications.slack", "NOTIFICATIONS_TELEGRAM": "notifications.telegram"}
REMOVED = {"migration.cdc": ("batch_delay_seconds",)}


def truthy(text) -> bool:
    return text if isinstance(text, bool) else str(text).strip().lower() in YES


def _fill(section, data: Mapping) -> None:
    for name in sorted(set(data) - {f.name for f in fields(section)}):
        log.info("setting %s has no use here", name)
    for f in fields(section):
        if f.name not in data:
            continue
        own = getattr(section, f.name)
        if is_dataclass(own):
            _fill(own, data[f.name] or {})
        elif data[f.name] is not None or own is None:
            setattr(section, f.name, data[f.name])


def _section(settings: Settings, path: str):
    for name in path.split("."):
        settings = getattr(settings, name)
    return settings


def _override(section, name: str, variable: str, text: str) -> None:
    own = getattr(section, name)
    if isinstance(own, bool):
        value = truthy(text)
    elif isinstance(own, (int, float)):
        try:
            value = type(own)(text)
        except ValueError:
            log.warning("%s isn't a number: %s", variable, text)
            return
    elif isinstance(own, list):
        value = [x.strip() for x in text.split(",") if x.strip()]
    else:
        value = text or (None if own is None else "")
    setattr(section, name, value)
    log.info("%s sets %s", variable, name)


def load(data: Mapping | None = None, environ: Mapping[str, str] | None = None) -> Settings:
    """Settings from a document; unknown keys are ignored, environment variables win, bad numbers are left out."""
    settings, environ = Settings(), os.environ if environ is None else environ
    _fill(settings, data or {})
    for path, names in REMOVED.items():
        given = data or {}
        for name in path.split("."):
            given = (given or {}).get(name) or {}
        for name in names:
            if name in given:
                log.warning("setting %s.%s is no longer used", path, name)
    for prefix, path in SECTIONS.items():
        section = _section(settings, path)
        for f in fields(section):
            variable = f"{prefix}_{f.name}".upper()
            if variable in environ and not is_dataclass(getattr(section, f.name)):
                _override(section, f.name, variable, environ[variable])
    for name, variable in (("state_file", "STATE_FILE"), ("environment", "ENVIRONMENT")):
        if environ.get(variable):
            setattr(settings, name, environ[variable])
    if not settings.notifications.teams.webhook_url:
        settings.notifications.teams.webhook_url = settings.notifications.webhook_url
    return settings


def read(path: str) -> Settings:
    """Settings from a JSON file, or a YAML file where a YAML reader is installed."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        data = json.loads(text)
    except ValueError:
        try:
            import yaml
        except ImportError:
            raise ValueError("no YAML reader is installed: write the settings as JSON") from None
        data = yaml.safe_load(text)
    return load(data)


class State:
    """Progress of snapshots in one JSON document: read, changed and replaced as a whole; a broken one starts anew."""

    def __init__(self, path: str):
        self.path, self.lock = path, threading.Lock()

    def get(self) -> dict:
        try:
            with open(self.path, encoding="utf-8") as f:
                data = json.load(f)
        except FileNotFoundError:
            data = {}
        except (OSError, ValueError) as e:
            log.error("state in %s can't be read, starting anew: %s", self.path, e)
            data = {}
        data = data if isinstance(data, dict) else {}
        tables = data.get("tables")
        return data | {"binlog": data.get("binlog"), "gtid": data.get("gtid"), "tables": tables if isinstance(tables, dict) else {}}

    def change(self, edit) -> dict:
        with self.lock:
            data = self.get()
            edit(data)
            folder = os.path.dirname(self.path) or "."
            os.makedirs(folder, exist_ok=True)
            with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, encoding="utf-8") as f:
                json.dump(data, f, indent=2)
            os.replace(f.name, self.path)
            return data

    def set_position(self, file: str, pos: int) -> None:
        self.change(lambda d: d.update(binlog={"file": file, "pos": int(pos)}))

    def set_gtid(self, gtid: str) -> None:
        self.change(lambda d: d.update(gtid=gtid))

    def table(self, name: str) -> dict:
        return {"status": "pending", "last_pk": None, "rows_processed": 0} | self.get()["tables"].get(name, {})

    def begin(self, name: str, version: int) -> int:
        """The version of a table's copy: that of the one it goes on with, or a new one."""
        def edit(data):
            own = {"status": "pending", "last_pk": None, "rows_processed": 0} | data["tables"].get(name, {})
            data["tables"][name] = own | {"status": "in_progress", "version": own.get("version") or version}

        return self.change(edit)["tables"][name]["version"]

    def unfinished(self) -> bool:
        return any(t.get("status") != "done" for t in self.get()["tables"].values())

    def hand_over(self, now):
        """The feed's place when the snapshot began, asked once and kept for a copy that goes on."""
        known = self.get().get("hand_over")
        if known is None:
            found = now()
            known = self.change(lambda d: d.update(hand_over=found))["hand_over"]
        if known and known.get("file") is not None:
            self.set_position(known["file"], known["pos"])
        return known["seq"] if known else None

    def progress(self, name: str, rows: int = 0, last_pk=None, done: bool = False) -> None:
        def edit(data):
            own = {"status": "pending", "last_pk": None, "rows_processed": 0} | data["tables"].get(name, {})
            own["rows_processed"] += int(rows)
            if last_pk is not None:
                own["last_pk"] = last_pk
            own["status"] = "done" if done else "in_progress"
            data["tables"][name] = own

        self.change(edit)
