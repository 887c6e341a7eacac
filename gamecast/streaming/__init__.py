"""Structured Streaming jobs."""

from .scoring import score_request_stream  # noqa: F401
from .models import latest_models, refresh_models_stream  # noqa: F401
