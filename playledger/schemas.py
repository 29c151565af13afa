"""Declared schemas of every external record, as DDL; JSON is never inferred."""

from __future__ import annotations

EMBEDDING_DIM = 768

# Fixed values below: field names of the services' records. What a record has besides the declared
# fields is kept as one JSON text, OTHER_FIELDS.
OTHER_FIELDS = "other_fields"

PLAY = (
    "name string, streamable string, url string, mbid string, loved string, "
    "artist struct<`#text`: string, mbid: string>, "
    "album struct<`#text`: string, mbid: string>, "
    "image array<struct<size: string, `#text`: string>>, "
    "date struct<uts: string, `#text`: string>, "
    "`@attr` struct<nowplaying: string>"
)
PLAY_PAGE = "recenttracks struct<track: array<string>>"

SCROBBLES = (
    "song string, artist string, album string, artist__mbid string, album__mbid string, "
    "dt timestamp, url string"
)

_LINKS = "struct<spotify: string>"
_IMAGES = "array<struct<url: string, height: bigint, width: bigint>>"
_RECENT_ARTIST = (
    f"struct<id: string, name: string, href: string, type: string, uri: string, external_urls: {_LINKS}>"
)
RECENT_PLAY = (
    "id string, name string, played_at timestamp, "
    f"artists array<{_RECENT_ARTIST}>, "
    "album struct<id: string, name: string, album_type: string, href: string, release_date: string, "
    "release_date_precision: string, total_tracks: bigint, type: string, uri: string, "
    f"external_urls: {_LINKS}, images: {_IMAGES}, artists: array<{_RECENT_ARTIST}>, "
    "available_markets: array<string>>, "
    "available_markets array<string>, disc_number bigint, duration_ms bigint, explicit boolean, "
    f"external_ids struct<isrc: string>, external_urls {_LINKS}, href string, is_local boolean, "
    "popularity bigint, preview_url string, track_number bigint, type string, uri string"
)

SEARCH_HIT = (
    "index string, type string, result struct<"
    "id: bigint, artist_names: string, full_title: string, primary_artist_names: string, "
    "title: string, title_with_featured: string, lyrics_state: string, "
    "release_date_components: struct<year: int, month: int, day: int>, "
    "stats: struct<pageviews: bigint, hot: boolean>>"
)
SEARCH_HITS = f"array<struct<{SEARCH_HIT}>>"

SEARCHES = (
    "song string, artist string, searchtext string, g_id bigint, g_artist_names string, "
    "g_full_title string, g_primary_artist_names string, g_title string, "
    "g_title_with_featured string, g_release_date date, g_pageviews bigint, "
    "g_lyrics_complete boolean"
)

MATCHES = (
    "song string, artist string, g_id bigint, g_title string, g_artist string, match_score int"
)

CATALOGUE = ("id bigint, title string, artist string")

_ARTIST = (
    "struct<api_path: string, header_image_url: string, id: bigint, image_url: string, "
    "is_meme_verified: boolean, is_verified: boolean, name: string, url: string, iq: bigint>"
)
SONG = (
    "annotation_count bigint, api_path string, apple_music_id string, apple_music_player_url string, "
    "artist_names string, description struct<plain: string>, embed_content string, full_title string, "
    "header_image_thumbnail_url string, header_image_url string, id bigint, language string, "
    "lyrics_owner_id bigint, lyrics_state string, path string, pending_lyrics_edits_count bigint, "
    "primary_artist_names string, recording_location string, relationships_index_url string, "
    "release_date date, release_date_for_display string, "
    "release_date_with_abbreviated_month_for_display string, song_art_image_thumbnail_url string, "
    "song_art_image_url string, song_art_primary_color string, song_art_secondary_color string, "
    "song_art_text_color string, title string, title_with_featured string, url string, "
    "album struct<api_path: string, cover_art_url: string, full_title: string, id: bigint, name: string, "
    "primary_artist_names: string, release_date_for_display: string, url: string, "
    f"artist: {_ARTIST}, primary_artists: array<{_ARTIST}>>, "
    f"primary_artist {_ARTIST}, primary_artists array<{_ARTIST}>, "
    f"featured_artists array<{_ARTIST}>, producer_artists array<{_ARTIST}>, "
    f"writer_artists array<{_ARTIST}>, "
    f"custom_performances array<struct<label: string, artists: array<{_ARTIST}>>>, "
    "media array<struct<provider: string, start: bigint, type: string, url: string, native_uri: string, "
    "attribution: string>>, "
    "translation_songs array<struct<api_path: string, id: bigint, language: string, lyrics_state: string, "
    "path: string, title: string, url: string>>"
)

LYRICS = ("id bigint, lyrics string")

EMBEDDINGS = ("id bigint, embedding array<double>")

EMBEDDING_RESULT = (
    "key string, response struct<embedding: struct<values: array<double>>>"
)

JOBS = (
    "name string, display_name string, state string, model string, "
    "create_time timestamp, start_time timestamp, end_time timestamp, update_time timestamp"
)

EXTRACTED = ("name string, file_name string")

LABELS = ("id bigint, cluster bigint")
CENTROIDS = ("cluster bigint, centroid array<double>")

TRAITS = ("OPN", "CON", "EXT", "AGR", "NEU")
TRAIT_SCORES = (
    "id bigint, " + ", ".join(f"{trait} double" for trait in TRAITS)
)
