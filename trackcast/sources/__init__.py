"""Inputs: delimited-file readers and the mapping from the driver's tables."""

from .delimited import (ARTIST_TERMS_COLUMNS, DOWNLOADS_COLUMNS, FEATURE_COLUMNS,
                        PLAY_COUNT_COLUMNS, REQUEST_COLUMNS, SIMILAR_ARTISTS_COLUMNS,
                        SONG_INFO_COLUMNS, TRACK_LIKES_COLUMNS, fields_to_columns,
                        keep_field_count, parse_requests, read_delimited, read_feature_file,
                        read_feature_index, read_requests, read_split_lines, split_fields,
                        text_schema)
from .fixtures import MusicInputs, SourceTables, music_inputs

__all__ = [
    "ARTIST_TERMS_COLUMNS", "DOWNLOADS_COLUMNS", "FEATURE_COLUMNS", "PLAY_COUNT_COLUMNS",
    "REQUEST_COLUMNS", "SIMILAR_ARTISTS_COLUMNS", "SONG_INFO_COLUMNS", "TRACK_LIKES_COLUMNS",
    "fields_to_columns", "keep_field_count", "parse_requests", "read_delimited",
    "read_feature_file", "read_feature_index", "read_requests", "read_split_lines",
    "split_fields", "text_schema", "MusicInputs", "SourceTables", "music_inputs",
]
