"""Requests to services: spacing, retries and errors, with the transport itself given by the caller."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

RETRIED = (500, 502, 503, 504)


class ServiceError(Exception):
    """A request that failed for good; status is None where there was no answer."""

    def __init__(self, message: str, status: int | None = None):
        super().__init__(message)
        self.status = status


@dataclass(frozen=True)
class Response:
    status: int
    body: bytes = b""
    headers: Mapping[str, str] = field(default_factory=dict)


#: (method, address, parameters) -> Response; a lost connection is ConnectionError, a time-out TimeoutError.
Transport = Callable[[str, str, Mapping[str, str]], Response]


@dataclass(frozen=True)
class Limits:
    """Spacing of request starts in seconds, requests at a time, attempts, seconds to wait for an answer."""

    delay: float = 0.5
    at_once: int | None = None
    attempts: int = 3
    timeout: float = 30.0


# Spacing and concurrency for each public service.
SERVICES: dict[str, Limits] = {
    "uniprot": Limits(0.5, 3), "interpro": Limits(0.15, 2), "string": Limits(1.0, 1), "go": Limits(0.12, 2),
    "alphafold": Limits(0.15, 2), "pdb": Limits(0.15, 3), "pubmed": Limits(0.35, 3), "kegg": Limits(0.4),
}


# Base addresses of the public services.
ADDRESSES = {
    "uniprot": "https://rest.uniprot.org", "interpro": "https://www.ebi.ac.uk/interpro/api", "string": "https://string-db.org/api", "go": "https://www.ebi.ac.uk/QuickGO/services",
    "alphafold": "https://alphafold.ebi.ac.uk/api", "pdb": "https://data.rcsb.org/rest/v1", "pubmed": "https://eutils.ncbi.nlm.nih.gov/entrez/eutils", "kegg": "https://rest.kegg.jp",
}

#: What stands between the ids of one request.
JOINED_BY = {"string": "\r\n", "go": ",", "pubmed": ",", "kegg": "+"}


@dataclass(frozen=True)
class Service:
    """How one service is asked: its base address, and who asks. limits: those of the service unless given."""

    name: str
    address: str = ""
    tool: str = "lattica"
    email: str | None = None
    api_key: str | None = None
    own_limits: Limits | None = None

    @property
    def limits(self) -> Limits:
        return self.own_limits or limits(self.name, self.api_key)

    def url(self, path: str) -> str:
        return f"{(self.address or ADDRESSES[self.name]).rstrip('/')}/{path.lstrip('/')}"

    def parameters(self, **more: object) -> dict[str, str]:
        """Parameters of a request with those that say who asks, where the service takes them; None is left out."""
        own: dict[str, object] = {}
        if self.name == "string":
            own = {"caller_identity": self.tool}
        if self.name == "pubmed":
            own = {"tool": self.tool, "email": self.email, "api_key": self.api_key}
        return {k: str(v) for k, v in (own | more).items() if v is not None}

    def joined(self, ids: Iterable[str]) -> str:
        """Many ids as the value of one parameter."""
        return JOINED_BY.get(self.name, ",").join(ids)


def text(requester: Requester, address: str, parameters: Mapping[str, str] | None = None) -> str:
    """The body of an answer as text; bytes that are no UTF-8 are replaced."""
    return requester.get(address, parameters).body.decode("utf-8", "replace")


def version(requester: Requester, service: Service) -> dict:
    """What the interaction service says of its release; {} where it gives an empty list."""
    found = json.loads(text(requester, service.url("json/version"), service.parameters()))
    return found if isinstance(found, dict) else found[0] if found else {}


def download(requester: Requester, address: str, path: str) -> bool:
    """Write the body of an answer, as it came, to a file of the local or mounted file system; False, and no file, where that fails."""
    try:
        body = requester.get(address).body
        target = Path(path)
        target.parent.mkdir(parents=True, exist_ok=True)
        partial = target.with_name(target.name + ".part")
        partial.write_bytes(body)
        partial.replace(target)
        return True
    except (ServiceError, OSError):
        return False


def limits(service: str, api_key: str | None = None) -> Limits:
    """Limits of a service; a key makes article requests closer."""
    return Limits(0.11, 3) if service == "pubmed" and api_key else SERVICES[service]


def backoff(status: int | None, attempt: int, retry_after: float | None = None) -> float | None:
    """Seconds to wait before the next attempt (attempts count from 0), or null if there is to be none. status is null for a lost connection."""
    if status == 429:
        return retry_after if retry_after is not None else float(2 ** (attempt + 1) * 5)
    if status is None or status in RETRIED:
        return float(2**attempt)
    return None


class Requester:
    """Sends requests one start per `delay`, repeated by `backoff`."""

    def __init__(self, transport: Transport, limits: Limits, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.transport, self.limits, self.clock, self.sleep = transport, limits, clock, sleep
        self._next, self._lock = float("-inf"), threading.Lock()
        self._slots = threading.Semaphore(limits.at_once) if limits.at_once else None

    def _wait(self) -> None:
        with self._lock:
            if (left := self._next - self.clock()) > 0:
                self.sleep(left)
            self._next = self.clock() + self.limits.delay

    def _once(self, method: str, address: str, parameters: Mapping[str, str]) -> Response | Exception:
        self._wait()
        try:
            return self.transport(method, address, parameters)
        except (ConnectionError, TimeoutError) as e:
            return e

    def request(self, method: str, address: str, parameters: Mapping[str, str] | None = None) -> Response:
        if self._slots:
            with self._slots:
                return self._request(method, address, parameters or {})
        return self._request(method, address, parameters or {})

    def _request(self, method: str, address: str, parameters: Mapping[str, str]) -> Response:
        failure: Exception | None = None
        for attempt in range(self.limits.attempts):
            answer = self._once(method, address, parameters)
            status = answer.status if isinstance(answer, Response) else None
            if isinstance(answer, Response) and status is not None and status < 400:
                return answer
            after = answer.headers.get("Retry-After") if isinstance(answer, Response) else None
            wait = backoff(status, attempt, float(after) if after and after.replace(".", "", 1).isdigit() else None)
            body = answer.body[:500].decode("utf-8", "replace") if isinstance(answer, Response) else str(answer)
            if status != 429:
                failure = ServiceError(f"{method} {address}: {status or 'no answer'} {body}", status)
            if wait is None:
                raise failure or ServiceError(f"{method} {address}: {status} {body}", status)
            self.sleep(wait)
        raise failure or ServiceError(f"{method} {address}: only refusals (429)", 429)

    def get(self, address: str, parameters: Mapping[str, str] | None = None) -> Response:
        return self.request("GET", address, parameters)

    def post(self, address: str, parameters: Mapping[str, str] | None = None) -> Response:
        return self.request("POST", address, parameters)
