"""Runs of named steps: which are left out, what happens on errors, several series, and the phases of a series."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

log = logging.getLogger(__name__)

#: When a full run is due, for the scheduler outside (fixed value).
SCHEDULE = "H 3 1,15 * *"
PHASES = {"Full": ("prepare", "gates", "upload"), "Prepare": ("prepare", "gates"), "Upload": ("gates", "upload")}


@dataclass
class Run:
    """What a run did: names of steps that ended well, and the error of each that did not."""

    done: list[str] = field(default_factory=list)
    failed: dict[str, Exception] = field(default_factory=dict)


def selected(steps: Sequence[tuple[str, Callable]], skipped: Iterable[str] = ()) -> list[tuple[str, Callable]]:
    """Steps whose name begins with none of the skipped prefixes, in order."""
    gone = tuple(skipped)
    return [s for s in steps if not (gone and s[0].startswith(gone))]


def run(steps: Sequence[tuple[str, Callable]], *args, skipped: Iterable[str] = (), on_error: str = "stop") -> Run:
    """Call each step with args; on an error stop (raise it) or continue with the next one."""
    out = Run()
    for name, step in selected(steps, skipped):
        try:
            step(*args)
        except Exception as error:
            out.failed[name] = error
            if on_error != "continue":
                raise
            log.warning("step %s failed: %s", name, error)
        else:
            out.done.append(name)
    return out


def run_series(series: Iterable[str], steps: Sequence[tuple[str, Callable]], **options) -> dict[str, Run]:
    """The steps for each series, which they get as their argument; one series' errors stay its own."""
    out: dict[str, Run] = {}
    for name in series:
        try:
            out[name] = run(steps, name, **options)
        except Exception as error:
            out[name] = Run(failed={"": error})
    return out


def run_phases(phases: dict[str, Callable], mode: str = "Full") -> list[str]:
    """The phases of a mode in order; an error in the gates keeps what follows from running."""
    if mode not in PHASES:
        raise ValueError(f"unknown mode {mode}")
    for name in PHASES[mode]:
        phases[name]()
    return list(PHASES[mode])
