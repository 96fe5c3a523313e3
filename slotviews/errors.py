"""Typed failures, so that a scheduler can tell a bad spec from missing data."""


class SlotViewsError(Exception):
    """Base class of every error raised by this package."""


class SpecError(SlotViewsError, ValueError):
    """A view spec, window or argument is not valid."""


class ReadError(SlotViewsError):
    """Input is missing or not complete."""


class WriteError(SlotViewsError):
    """Rows cannot be stored as asked."""


class DedupError(SlotViewsError):
    """A deduplication key cannot be resolved."""


class BuilderError(SlotViewsError):
    """A view's SQL step or builder function failed."""


class QualityError(SlotViewsError):
    """A data-quality definition cannot be evaluated."""


class NoQualityDefinition(QualityError):
    """No data-quality definition exists for the view."""


class ExportError(SlotViewsError):
    """A data-quality report cannot be stored."""
