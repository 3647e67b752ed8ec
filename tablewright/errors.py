"""One error and one warning for tables, one error for scripts."""


class TableError(Exception):
    """A table, a column or a value cannot be taken, converted or written."""


class TableWarning(Warning):
    """Something was done in another way than asked for."""


class ScriptError(Exception):
    """A data function cannot be run as it is described."""
