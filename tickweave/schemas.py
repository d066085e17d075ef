"""Schemas and fixed values of capture data."""

from __future__ import annotations

from pyspark.sql import types as T

#: The ten inputs in bit order, and masks over them.
BUTTONS = ("up", "down", "left", "right", "a", "b", "c", "d", "change", "spell")
ALL_MASK, DIRECTION_MASK, BUTTON_MASK = 0x3FF, 0x00F, 0x3F0
PLAYERS = ("p1", "p2")
#: Columns that can hold the engine tick, in order of preference.
TICK_COLUMNS = ("game_frame", "local_frame", "frame_index")
FRAMES_PER_SECOND = 60
MIN_REPLAY_BYTES, MAX_FRAMES, MAX_DECK = 100, 600_000, 20
#: Names by id.
CHARACTERS = (
    "Reimu", "Marisa", "Sakuya", "Alice", "Patchouli", "Youmu", "Remilia", "Yuyuko", "Yukari", "Suika",
    "Reisen", "Aya", "Komachi", "Iku", "Tenshi", "Sanae", "Cirno", "Meiling", "Utsuho", "Suwako",
)
STAGES = (
    "Hakurei Shrine", "Forest of Magic", "Scarlet Devil Mansion Clock Tower", "SDM Library", "Netherworld",
    "Hakugyokurou Snowy Garden", "Bamboo Forest of the Lost", "Bhava-Agra", "Youkai Mountain", "Heaven",
    "SDM Foyer", "Spring Path (Hakurei)", "Scarlet Devil Mansion Rooftop", "Moriya Shrine", "Mouth of Geyser",
    "Cauldera of Spirits", "Nuclear Reactor Core", "SDM Basement", "Fusion Reactor", "Generic Stage",
)

VALIDATION = T.StructType(
    [
        T.StructField("csv_rows", T.LongType()),
        T.StructField("frame_column", T.StringType()),
        T.StructField("mask_mismatches", T.LongType()),
        T.StructField("decreases", T.LongType()),
        T.StructField("distinct_frames", T.LongType()),
        T.StructField("duplicate_rows", T.LongType()),
        T.StructField("duplicate_ratio", T.DoubleType()),
        T.StructField("video_frames", T.LongType()),
    ]
)
#: One line for each attempt at a capture.
MANIFEST = T.StructType(
    [
        T.StructField("replay_id", T.StringType()),
        T.StructField("source_rep", T.StringType()),
        T.StructField("source_sha256", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("frames", T.LongType()),
        T.StructField("elapsed_ms", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("video", T.StringType()),
        T.StructField("csv", T.StringType()),
        T.StructField("video_sha256", T.StringType()),
        T.StructField("csv_sha256", T.StringType()),
        T.StructField("validation", VALIDATION),
        T.StructField("meta", T.MapType(T.StringType(), T.StringType())),
    ]
)
STATUS = "status string, replay string, frames long, elapsed_ms long, reason string"
#: One object for each listed replay.
LISTING = (
    "id long, serverCharacter int, clientCharacter int, serverCards array<long>, clientCards array<long>, "
    "serverUserElo double, clientUserElo double, winner int, serverRounds int, clientRounds int, "
    "unranked boolean, mountainVaporBug boolean, serverUserNick string, clientUserNick string"
)
SHARD_INDEX = "array<struct<root:string,rel:string,frames:bigint>>"

_PLAYER = "{p}_character_id int, {p}_character string, {p}_palette int, {p}_deck_cards array<int>, "
#: What decoding one replay file gives; frames hold both players' masks.
REPLAY = (
    "file_path string, file_hash string, file_size long, game_version long, "
    + _PLAYER.format(p="p1") + _PLAYER.format(p="p2")
    + "stage_id int, stage_name string, music_id int, total_frames long, strategy string, "
    "parse_errors array<string>, frames array<struct<p1:int,p2:int>>"
)
#: Texts of the errors that decoding a replay meets; readers of stored replays look for them.
REPLAY_ERRORS = {
    "small": "File too small ({size} bytes)",
    "header": "Header parse error: {error}",
    "second": "P2 header beyond file bounds",
    "deck": "{player} deck extends beyond file",
    "inputs": "Could not find compressed input data",
    "no_frames": "No frame data in decompressed stream",
    "many_frames": "Frame count {count} exceeds maximum {most}",
    "idle": "Warning: all inputs are zero (possible parse error)",
}
SCHEMA_VERSION = 1
