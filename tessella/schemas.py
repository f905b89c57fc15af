"""Row types of the engine's tables, and the values that its columns may take."""

from __future__ import annotations

RESOURCE = "resource_id string, container string, resource_path string, resource_type string, size bigint, source_sha256 string, processing_status string"
EXCLUSION = "container string, resource_path string, reason string, detail string"
COLLISION = f"resource_path string, resources array<struct<{RESOURCE.replace(' ', ':').replace(',:', ',')}>>, content_identical boolean, unresolved boolean"
FINDINGS = "array<struct<code:string,severity:string>>"
CONTEXT = "struct<bundle:string,key:string,container:string,path:string>"
UNIT = f"id string, source string, source_sha256 string, target string, context {CONTEXT}, status string, findings {FINDINGS}"
STALE_UNIT = f"id string, context {CONTEXT}, old_source_sha256 string, reason string, scan_build string"
MANIFEST = "id string, sha256 string, size bigint"
CHECKPOINT = "schema_version int, completed_sequence bigint, current_sequence bigint, current_batch string, counts struct<exported:bigint>, unit_ids array<string>, batch_digest string, next_command string"

# Fixed values of the data model.
STATUSES = ("open", "translated", "technically_reviewed", "linguistically_reviewed")
REVIEWED = ("technically_reviewed", "linguistically_reviewed")
RESOURCE_TYPES = ("file_template", "inspection_description", "intention_description", "postfix_template", "properties", "tip")
EXCLUSION_REASONS = (
    "already_localized", "container_budget_exceeded", "corrupt_archive", "collision_not_selected", "directory", "duplicate_member",
    "localized", "member_budget_exceeded", "nested_archive", "nested_jar_too_large", "not_in_translation_reference",
    "non_translatable_resource", "not_jar", "resource_too_large", "total_nested_jar_bytes_exceeded", "total_resource_bytes_exceeded",
    "third_party_container", "unsafe_path", "unsupported_compression", "unsupported_resource",
)
CANDIDATE_REASONS = ("not_in_translation_reference", "collision_not_selected", "resource_too_large", "total_resource_bytes_exceeded", "unsupported_compression", "corrupt_archive")
TECHNICAL_DROPS = ("resource_too_large", "total_resource_bytes_exceeded", "unsupported_compression", "corrupt_archive")
BLOCKING = ("empty_target", "message_format_invalid", "markup_structure_changed", "link_changed", "placeholder_mismatch")
WARNINGS = ("length_ratio", "glossary_mismatch")
FINDING_CODES = (*BLOCKING, *WARNINGS)  # in the order in which a pair's findings are listed
STALE_REASONS = ("removed_from_source", "context_changed", "source_changed")
WORKFLOW_STATES = ("scan", "translate", "validate", "generate", "package", "complete")


class EngineError(ValueError):
    """An input or a table breaks a rule of its domain."""


class ScanError(EngineError): ...
class SourceError(EngineError): ...
class ConfigError(EngineError): ...
class PropertiesError(EngineError): ...
class StateError(EngineError): ...
class QueueError(EngineError): ...
class RenderError(EngineError): ...
class PackageError(EngineError): ...
class ChangelogError(EngineError): ...
class OutputPathError(EngineError): ...
