"""What the machine that a driver runs on says of itself, as far as it can be asked; every failure gives None."""

from __future__ import annotations

import json
import threading
import urllib.request
from collections.abc import Callable

# The documented paths of the instance metadata service.
TOKEN, IDENTITY, NOTICE = "api/token", "dynamic/instance-identity/document", "meta-data/spot/instance-action"
FIELDS = ("instanceId", "instanceType", "availabilityZone", "region")


def _asked(url: str, timeout: float, method: str = "GET", headers: dict[str, str] | None = None) -> str | None:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, method=method, headers=headers or {}), timeout=timeout) as answer:
            return answer.read().decode()
    except (OSError, ValueError):
        return None


def token(base: str, timeout: float = 2.0, seconds: int = 300) -> str | None:
    return _asked(f"{base}/{TOKEN}", timeout, "PUT", {"X-aws-ec2-metadata-token-ttl-seconds": str(seconds)})


def value(base: str, path: str, secret: str | None, timeout: float = 2.0) -> str | None:
    return _asked(f"{base}/{path}", timeout, headers={"X-aws-ec2-metadata-token": secret} if secret else None)


def _document(text: str | None) -> dict:
    try:
        found = json.loads(text or "")
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def identity(base: str, timeout: float = 2.0) -> dict[str, str | None]:
    """The instance's id, type, zone and region, each None where it isn't known."""
    found = _document(value(base, IDENTITY, token(base, timeout), timeout))
    return {name: found.get(name) for name in FIELDS}


def notice(base: str, timeout: float = 2.0) -> dict | None:
    """The notice that the instance is about to be taken away, if there is one."""
    return _document(value(base, NOTICE, token(base, timeout), timeout)) or None


class Watcher(threading.Thread):
    """Asks for the notice every ``seconds`` and calls ``told(notice)`` once, as a stream's ``stop`` would be; ``close`` ends it."""

    def __init__(self, base: str, told: Callable[[dict], object], seconds: float = 5.0, timeout: float = 2.0):
        super().__init__(daemon=True, name="notices")
        self._base, self._told, self._seconds, self._timeout, self._ended = base, told, seconds, timeout, threading.Event()

    def run(self) -> None:
        while not self._ended.is_set():
            if found := notice(self._base, self._timeout):
                self._told(found)
                return
            self._ended.wait(self._seconds)

    def close(self) -> None:
        self._ended.set()
