"""The three failures the engine reports."""


class ValidationError(ValueError):
    """Input does not have the promised shape or content."""


class InsufficientDataError(ValueError):
    """Fewer labelled rows than training needs."""

    def __init__(self, required: int, actual: int):
        super().__init__(f"need at least {required} labelled rows, found {actual}")
        self.required = required
        self.actual = actual


class ModelNotReadyError(RuntimeError):
    """No fitted model at the given location."""
