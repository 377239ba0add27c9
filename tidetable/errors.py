"""Exceptions raised by the toolkit."""

from __future__ import annotations


class LoadError(RuntimeError):
    """A load could not be carried out."""


class TableExistsError(LoadError):
    """The target exists and ``if_exists="error"`` was asked for."""


class NoValidRecordsError(LoadError):
    """Nothing in the input could be stored, so nothing was published."""


class ResultNotReadyError(RuntimeError):
    """A stored result does not exist or was not finished."""


class ResultFailedError(RuntimeError):
    """A stored result could not be written; the message says why."""
