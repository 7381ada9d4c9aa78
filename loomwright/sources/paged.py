"""Paged services as Spark sources: issues with comments, requests with files, commits of requests.

A fetch function takes (address, parameters) and returns parsed JSON; it is the only thing that touches a network, so tests and
offline copies bring their own. Each repository is one partition, read by one task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from loomwright.sources.readers import COMMITS, ISSUES, PRS

#: Rows of a page, attempts and seconds between them (times the attempt).
PAGE, ATTEMPTS, WAIT = 100, 3, 2.0
Fetch = Callable[[str, dict], object]


def retrying(fetch: Fetch, attempts: int = ATTEMPTS, wait: float = WAIT) -> Fetch:
    """fetch, tried again after errors with waits that grow by one step each."""

    def get(address: str, parameters: dict):
        for k in range(1, attempts + 1):
            try:
                return fetch(address, parameters)
            except Exception:
                if k == attempts:
                    raise
                time.sleep(wait * k)

    return get


def pages(fetch: Fetch, address: str, **parameters) -> Iterator[dict]:
    """All rows of a list, page by page, up to the first page that is not full."""
    page = 1
    while True:
        rows = fetch(address, {**parameters, "per_page": PAGE, "page": page})
        yield from rows
        if len(rows) < PAGE:
            return
        page += 1


def _name(x: dict | None, key: str = "login") -> str | None:
    return (x or {}).get(key)


def issue_rows(fetch: Fetch, repo: str) -> Iterator[tuple]:
    """Issues in any state; requests, which the list also holds, are left out."""
    for x in pages(fetch, f"{repo}/issues", state="all"):
        if "pull_request" in x:
            continue
        comments = [(_name(c.get("user")), c.get("created_at"), c.get("body") or "") for c in pages(fetch, f"{repo}/issues/{x['number']}/comments")] if x.get("comments") else []
        yield repo, x["number"], x.get("title") or "", x.get("state"), [label["name"] for label in x.get("labels", [])], x.get("created_at"), x.get("closed_at"), x.get("body") or "", comments, x.get("html_url")


def _files(rows) -> list[tuple]:
    return [(f.get("filename"), f.get("status"), f.get("additions") or 0, f.get("deletions") or 0, f.get("changes") or 0) for f in rows]


def request_rows(fetch: Fetch, repo: str) -> Iterator[tuple]:
    """Requests in any state with their details and files; issue numbers are left to `rules.issue_numbers`."""
    for x in pages(fetch, f"{repo}/pulls", state="all"):
        more = fetch(f"{repo}/pulls/{x['number']}", {})
        files = _files(pages(fetch, f"{repo}/pulls/{x['number']}/files"))
        labels = [label["name"] for label in more.get("labels", [])]
        yield repo, x["number"], more.get("title") or "", more.get("state"), bool(more.get("merged")), bool(more.get("draft")), _name(more.get("user")), labels, more.get("body") or "", more.get("changed_files") or 0, None, files


def reference_rows(fetch: Fetch, repo: str) -> Iterator[tuple]:
    """(repo, sha, number) for each commit of each request."""
    for x in pages(fetch, f"{repo}/pulls", state="all"):
        for c in pages(fetch, f"{repo}/pulls/{x['number']}/commits"):
            yield repo, c["sha"], x["number"]


def commit_details(references: DataFrame, fetch: Fetch, attempts: int = ATTEMPTS, wait: float = WAIT) -> DataFrame:
    """Commits of the references (repo, sha, number): each sha once, with the numbers of all its requests.

    References meet by a shuffle and each task asks for the commits it was dealt, so no task holds a repository's."""
    get = retrying(fetch, attempts, wait)
    once = references.where("sha is not null").groupBy("repo", "sha").agg(F.sort_array(F.collect_set(F.col("number").cast("long"))).alias("pr_numbers"))
    schema = T.StructType.fromDDL(COMMITS)

    def ask(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        for b in batches:
            rows = []
            for repo, sha, numbers in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                x = get(f"{repo}/commits/{sha}", {})
                c = x.get("commit") or {}
                values = repo, sha, _name(c.get("author"), "name"), c.get("message") or "", _name(c.get("committer"), "date"), [], numbers, [dict(zip(FILE_FIELDS, f, strict=True)) for f in _files(x.get("files") or [])]
                rows.append(dict(zip(schema.names, values, strict=True)))
            yield pa.RecordBatch.from_pylist(rows, schema=to_arrow_schema(schema))

    return once.select("repo", "sha", "pr_numbers").mapInArrow(ask, schema)


def commit_rows(fetch: Fetch, repo: str) -> Iterator[tuple]:
    """Commits of the repository's requests by one task, each sha once with the numbers of all its requests; see commit_details for many repositories."""
    of: dict[str, list[int]] = {}
    for _, sha, number in reference_rows(fetch, repo):
        of.setdefault(sha, []).append(number)
    for sha, numbers in of.items():
        x = fetch(f"{repo}/commits/{sha}", {})
        c = x.get("commit") or {}
        yield repo, sha, _name(c.get("author"), "name"), c.get("message") or "", _name(c.get("committer"), "date"), [], sorted(set(numbers)), _files(x.get("files") or [])


KINDS = {"issues": (ISSUES, issue_rows), "requests": (PRS, request_rows), "commits": (COMMITS, commit_rows), "references": ("repo string, sha string, number bigint", reference_rows)}

FILE_FIELDS = ("filename", "status", "additions", "deletions", "changes")


def paged_source(name: str, kind: str, fetch: Fetch, attempts: int = ATTEMPTS, wait: float = WAIT) -> type[DataSource]:
    """A source to register: spark.read.format(name).option("repos", "owner/a,owner/b").load()."""
    ddl, rows = KINDS[kind]
    get = retrying(fetch, attempts, wait)

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.repos = [r.strip() for r in options.get("repos", "").split(",") if r.strip()]

        def partitions(self):
            return [InputPartition(r) for r in self.repos]

        def read(self, partition):
            yield from rows(get, partition.value) if partition is not None and partition.value else ()

    class Paged(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return ddl

        def reader(self, schema):
            return Reader(self.options)

    return Paged


def changed_since(fetch: Fetch, repo: str, since: str, until: str) -> Iterator[dict]:
    """Issues with since < updated_at <= until, each once, oldest change first.

    Asked for from the last time seen on, not by page numbers, so an issue that changes meanwhile moves no other one past the reader;
    rows of one time are told apart by their numbers. An issue that changes beyond `until` meanwhile is left to the next read."""
    cursor, seen, page = since, set(), 1
    while True:
        rows = fetch(f"{repo}/issues", {"state": "all", "sort": "updated", "direction": "asc", "since": cursor, "per_page": PAGE, "page": page})
        for x in rows:
            key = x["number"], x["updated_at"]
            if since < x["updated_at"] <= until and key not in seen:
                seen.add(key)
                yield x
        if len(rows) < PAGE or rows[-1]["updated_at"] > until:
            return
        last = rows[-1]["updated_at"]
        if last > cursor:
            # What was seen at earlier times cannot come again.
            cursor, page, seen = last, 1, {k for k in seen if k[1] >= last}
        else:
            page += 1


CHANGES = "repo string, issue_number bigint, updated_at string, title string, state string, labels array<string>, body string, is_request boolean"


def change_stream(name: str, fetch: Fetch, attempts: int = ATTEMPTS, wait: float = WAIT) -> type[DataSource]:
    """A streaming source to register: spark.readStream.format(name).option("repos", "owner/a,owner/b").load().

    The offset is the time of the last change of each repository, so a restart goes on after the last batch; a batch that runs
    again asks for the same span of time. Each repository is one partition."""
    get = retrying(fetch, attempts, wait)

    class Reader(DataSourceStreamReader):
        def __init__(self, options):
            self.repos = [r.strip() for r in options.get("repos", "").split(",") if r.strip()]

        def initialOffset(self):
            return dict.fromkeys(self.repos, "")

        def latestOffset(self, *_):
            found = {}
            for r in self.repos:
                newest = get(f"{r}/issues", {"state": "all", "sort": "updated", "direction": "desc", "since": "", "per_page": 1, "page": 1})
                found[r] = newest[0]["updated_at"] if newest else ""
            return found

        def partitions(self, start, end):
            return [InputPartition((r, start.get(r, ""), end[r])) for r in self.repos if end.get(r, "") > start.get(r, "")]

        def read(self, partition):
            repo, since, until = partition.value
            for x in changed_since(get, repo, since, until):
                yield repo, x["number"], x["updated_at"], x.get("title") or "", x.get("state"), [label["name"] for label in x.get("labels", [])], x.get("body") or "", "pull_request" in x

        def commit(self, end):
            pass

    class Changes(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return CHANGES

        def streamReader(self, schema):
            return Reader(self.options)

    return Changes
