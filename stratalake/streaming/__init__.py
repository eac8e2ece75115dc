from stratalake.streaming.compaction import merge_events, remove_merged_files
from stratalake.streaming.ingest import envelope, start_ingest

__all__ = ["envelope", "merge_events", "remove_merged_files", "start_ingest"]
