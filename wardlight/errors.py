"""Exceptions raised by the checks."""


class ValidationError(Exception):
    """A data set does not hold what it should."""


class SchemaValidationError(ValidationError):
    """Columns are missing or have the wrong names."""


class DataIntegrityError(ValidationError):
    """Columns hold values they must not hold."""


class FeatureValidationError(Exception):
    """A frame does not carry the columns the models are built on."""


class MetricValidationError(Exception):
    """Evaluation figures contradict each other or leave their range."""
