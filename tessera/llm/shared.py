"""Cutting lineage through the shared folder of the cluster, as the operators of the core do."""

from tessera.operators.stages import fresh_path, materialize, recorded, release, release_paths, remove, scratch, shared_dir

__all__ = ["fresh_path", "materialize", "recorded", "release", "release_paths", "remove", "scratch", "shared_dir"]
