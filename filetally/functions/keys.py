"""Surrogate keys, as SQL text. Plain ``concat`` keeps a null part visible as a null key."""

from __future__ import annotations


def entry_key(kind: str, identity: str) -> str:
    return f"concat({kind}, ':', {identity})"


def property_key(file_id: str, template_id: str, field: str) -> str:
    return f"concat({file_id}, '|', {template_id}, '|', {field})"


def acl_key(resource_id: str, principal_type: str, identity: str) -> str:
    return f"concat({resource_id}, '|', {principal_type}, '|', {identity})"


def version_key(file_id: str, rev: str, content_hash: str) -> str:
    return f"concat({file_id}, ':', {rev}, ':', {content_hash})"
