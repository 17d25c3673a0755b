"""Notices about a running engine, sent to chat services; a service that fails doesn't keep the others from being told.

A notice has a topic, a sentence, facts and a level.  It is laid out once, as a heading, a body and labelled lines, and
each service puts these into the form that it takes, within its limits.
"""

from __future__ import annotations

import json
import logging
import time
import traceback
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone
from html import escape

from tidemark.plans.settings import Notifications

log = logging.getLogger(__name__)

Post = Callable[[str, dict], tuple[int, str]]
#: Limits of the services, in characters and fields.
SLACK_HEADING, SLACK_FIELD, SLACK_FIELDS, TELEGRAM_TEXT = 150, 2000, 10, 4096


@dataclass(frozen=True)
class Level:
    """How a level is marked: a word before the heading, and a colour in each service's own terms."""

    word: str
    card: str
    bar: str


INFO, WARNING, ERROR = Level("note", "accent", "#4A90D9"), Level("attention", "warning", "#D9A441"), Level("failure", "attention", "#B3261E")


@dataclass
class Notice:
    topic: str
    text: str
    level: Level = INFO
    facts: Mapping = field(default_factory=dict)
    error: BaseException | None = None


def whereabouts(error: BaseException | None) -> str | None:
    """Module and line of this package in which an error began, outermost call last."""
    if error is None:
        return None
    own = [f"{frame.f_globals.get('__name__')}:{line}" for frame, line in traceback.walk_tb(error.__traceback__)]
    return " < ".join(reversed([x for x in own if x.startswith("tidemark")])) or None


def brief(value, most: int) -> str:
    text = value if isinstance(value, str) else json.dumps(value, default=str)
    return text if len(text) <= most else text[: max(0, most - 1)] + "…"


@dataclass
class Layout:
    """A notice as text: heading, body, and (label, value) lines, every value at most `most` characters."""

    notice: Notice
    stage: str = "prod"

    @property
    def heading(self) -> str:
        return f"[{self.stage}] {self.notice.level.word}: {self.notice.topic}"

    def lines(self, most: int) -> list[tuple[str, str]]:
        at = whereabouts(self.notice.error)
        facts = dict(self.notice.facts) | ({"where": at} if at else {}) | {"at": f"{datetime.now(timezone.utc):%Y-%m-%d %H:%M:%S}Z"}
        return [(str(k), brief(v, most)) for k, v in facts.items()]


def post(url: str, payload: dict, timeout: float = 10) -> tuple[int, str]:
    request = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json"})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status, answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


def adaptive_card(x: Layout) -> dict:
    facts = [{"title": k, "value": v} for k, v in x.lines(500)]
    body = [
        {"type": "TextBlock", "text": x.heading, "weight": "bolder", "color": x.notice.level.card, "wrap": True},
        {"type": "TextBlock", "text": x.notice.text, "wrap": True},
        {"type": "FactSet", "facts": facts},
    ]
    card = {"$schema": "http://adaptivecards.io/schemas/adaptive-card.json", "type": "AdaptiveCard", "version": "1.4", "body": body}
    return {"type": "message", "attachments": [{"contentType": "application/vnd.microsoft.card.adaptive", "content": card}]}


def slack_blocks(x: Layout) -> dict:
    fields = [{"type": "mrkdwn", "text": brief(f"*{k}* {v}", SLACK_FIELD)} for k, v in x.lines(400)][:SLACK_FIELDS]
    blocks = [
        {"type": "header", "text": {"type": "plain_text", "text": brief(x.heading, SLACK_HEADING)}},
        {"type": "section", "text": {"type": "mrkdwn", "text": brief(x.notice.text, SLACK_FIELD)}},
        {"type": "section", "fields": fields},
    ]
    return {"text": x.heading, "attachments": [{"color": x.notice.level.bar, "blocks": blocks}]}


def telegram_text(x: Layout, chat: str) -> dict:
    """Whole lines as long as they fit, heading and body first."""
    parts = [f"<b>{escape(brief(x.heading, 300))}</b>", escape(brief(x.notice.text, 1000)), *(f"{escape(k)}: <code>{escape(v)}</code>" for k, v in x.lines(300))]
    ends = [0]
    for part in parts:
        ends.append(ends[-1] + len(part) + 1)
    fit = max(i for i, end in enumerate(ends) if end <= TELEGRAM_TEXT)
    return {"chat_id": chat, "parse_mode": "HTML", "text": "\n".join(parts[:fit])}


@dataclass
class Service:
    """Where notices go: an address, the form of a notice there, and what answer means that it came through."""

    name: str
    url: str
    form: Callable[[Layout], dict]
    came_through: Callable[[int, str], bool]


def teams(url: str) -> Service:
    return Service("teams", url, adaptive_card, lambda status, text: status // 100 == 2)


def slack(url: str) -> Service:
    return Service("slack", url, slack_blocks, lambda status, text: status == 200 and text.strip() == "ok")


def telegram(token: str, chat) -> Service:
    def ok(status: int, text: str) -> bool:
        try:
            return status == 200 and bool(json.loads(text)["ok"])
        except (ValueError, KeyError, TypeError):
            return False

    return Service("telegram", f"https://api.telegram.org/bot{token}/sendMessage", lambda x: telegram_text(x, str(chat)), ok)


class Dispatcher:
    """pause: seconds that a topic keeps still after a notice of it; 0 for none."""

    def __init__(self, services: Iterable[Service], pause: float = 60, stage: str = "prod", send: Post = post, clock: Callable[[], float] = time.monotonic):
        self.services, self.pause, self.stage, self.send_to, self.clock = list(services), pause, stage or "prod", send, clock
        self.quiet_until: dict[str, float] = {}

    def tell(self, notice: Notice, topic: str | None = None) -> bool:
        """Whether the notice reached anyone."""
        topic, now = topic or notice.level.word, self.clock()
        if now < self.quiet_until.get(topic, now):
            return False
        self.quiet_until[topic] = now + self.pause
        return any([self._reached(s, Layout(notice, self.stage)) for s in self.services])

    def _reached(self, service: Service, layout: Layout) -> bool:
        try:
            return service.came_through(*self.send_to(service.url, service.form(layout)))
        except Exception:  # noqa: BLE001
            log.exception("%s can't be told", service.name)
            return False

    def error(self, kind: str, table: str, text: str, facts: Mapping | None = None, error: BaseException | None = None) -> bool:
        return self.tell(Notice(f"{kind} of {table}", text, ERROR, dict(facts or {}), error))

    def warning(self, kind: str, table: str, text: str, facts: Mapping | None = None) -> bool:
        return self.tell(Notice(f"{kind} of {table}", text, WARNING, dict(facts or {})))

    def info(self, kind: str, text: str, facts: Mapping | None = None) -> bool:
        return self.tell(Notice(kind, text, INFO, dict(facts or {})))

    def started(self, facts: Mapping, mode: str = "cdc") -> bool:
        return self.tell(Notice(f"{mode} run", "begins", INFO, dict(facts)), "begin")

    def stopped(self, reason: str) -> bool:
        return self.tell(Notice("run", f"ended: {reason}", WARNING), "end")


def from_settings(s: Notifications, stage: str = "prod", send: Post = post) -> Dispatcher | None:
    """A dispatcher over the services that are enabled and have an address; None without any."""
    if not s.enabled:
        return None
    found = []
    if s.teams.enabled and s.teams.webhook_url.strip():
        found.append(teams(s.teams.webhook_url.strip()))
    if s.slack.enabled and s.slack.webhook_url.strip():
        found.append(slack(s.slack.webhook_url.strip()))
    if s.telegram.enabled and s.telegram.bot_token.strip() and str(s.telegram.chat_id).strip():
        found.append(telegram(s.telegram.bot_token.strip(), s.telegram.chat_id))
    return Dispatcher(found, s.rate_limit_seconds, stage, send) if found else None
