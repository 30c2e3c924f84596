"""Vocabularies and schemas of the normalized model: one row is one conversation."""

from __future__ import annotations

# The closed vocabularies.
SOURCES = ("chatgpt", "claude-chat", "claude-code", "codex", "hermes")
ROLES = ("user", "assistant", "system", "tool")
KINDS = ("image", "file", "audio", "other")
STATUSES = ("imported", "skipped", "failed")
STAGES = ("source", "hash", "state", "sanitize", "classify", "enrich", "archive", "retain", "unknown")
CATEGORIES = (
    "private-key", "anthropic-key", "openai-key", "github-token", "gitlab-token", "aws-access-key", "jwt",
    "kubernetes-secret", "connection-string", "bearer-token", "api-key", "password", "dotenv-value",
)
UNKNOWN_PROJECT = "unknown"
SLUG = r"^[a-z0-9][a-z0-9._-]*$"

TOOL = "struct<name: string, request: string, result: string>"
PART = "struct<kind: string, name: string>"
#: Fields in alphabetical order, which is the order of the canonical JSON.
MESSAGE = f"struct<non_text_parts: array<{PART}>, role: string, sent_at: timestamp, text: string, tool_activity: array<{TOOL}>>"
CONVERSATION = f"source string, source_id string, title string, started_at timestamp, last_activity_at timestamp, messages array<{MESSAGE}>"
STATE = "source string, source_id string, content_hash string, document_id string, recorded_at timestamp, status string, error string"
EMPTY_TOOLS = f"cast(array() as array<{TOOL}>)"
EMPTY_PARTS = f"cast(array() as array<{PART}>)"
