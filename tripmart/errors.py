"""Typed errors raised by the library."""

from __future__ import annotations


class TripmartError(RuntimeError):
    """Base class of every error raised on purpose."""


class SchemaError(TripmartError):
    """A raw trip source lacks columns that classification needs."""


class ZoneLookupError(TripmartError):
    """The zone lookup is empty or holds ids that are not whole numbers."""


class MissingRelation(TripmartError):
    """A served query needs a relation that the warehouse does not hold."""


class EmptyResult(TripmartError):
    """A served query matched no rows."""


class UnknownZone(TripmartError):
    """A served query names a zone that is not in the zone dimension."""


class SummaryError(TripmartError):
    """The newest quality summary is missing or malformed."""


class CommitConflict(TripmartError):
    """Another run published its tables after this one began; nothing of this run is visible."""


class InvalidRequest(ValueError):
    """An argument lies outside its allowed range."""
