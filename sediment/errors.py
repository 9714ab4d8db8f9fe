"""Errors a job stops on before it writes anything."""


class InvalidSnapshot(ValueError):
    """A snapshot is missing or cannot be read as one: no usable time, ids that repeat, keys in a circle."""


class DuplicateKey(ValueError):
    """An append that must not meet a key twice would do so."""


class UnsafeOutput(ValueError):
    """The output folder would overwrite an input."""


class ChangedOutput(RuntimeError):
    """Another run published to the same output while this one was at work."""


class NullValue(ValueError):
    """An append would put a null where the table allows none."""
