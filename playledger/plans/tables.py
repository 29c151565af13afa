"""Names of the tables the stages read and write."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Tables:
    """Table names, in a database for the listening history and one for the song library."""

    listening: str = "listening"
    library: str = "library"

    @property
    def scrobbles(self) -> str:
        return f"{self.listening}.scrobbles"

    @property
    def matches(self) -> str:
        return f"{self.listening}.song_matches"

    @property
    def searches(self) -> str:
        return f"{self.listening}.song_searches"

    @property
    def songs(self) -> str:
        return f"{self.library}.songs"

    @property
    def lyrics(self) -> str:
        return f"{self.library}.lyrics"

    def embeddings(self, task: str | None = None) -> str:
        """Embedding table of a task: plain or `clustering`."""
        if task not in (None, "clustering"):
            raise NotImplementedError(f"No embedding tables for task {task}")
        return f"{self.library}.lyrics_embed" + (f"_{task}" if task else "")

    def jobs(self, task: str | None = None) -> str:
        return f"{self.embeddings(task)}_jobs"

    def extracted(self, task: str | None = None) -> str:
        """Result files already in the embedding table of a task."""
        return f"{self.embeddings(task)}_extracted"

    @property
    def clustering(self) -> str:
        return f"{self.library}.lyrics_clustering"

    @property
    def clusters(self) -> str:
        return f"{self.library}.lyrics_clusters"

    @property
    def centroids(self) -> str:
        return f"{self.library}.lyrics_cluster_centroids"

    @property
    def traits(self) -> str:
        return f"{self.library}.lyrics_big5"

    def recent(self, kind: str) -> str:
        return f"{self.listening}.recent_{kind}"
