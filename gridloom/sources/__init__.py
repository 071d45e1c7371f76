"""Manifests of files, cell tables, and chunk stores."""
