"""Declared schemas of payloads, messages and stored collections, as DDL text."""

# Messages: the canonical columns of the three topics.
EARTHQUAKE = (
    "event_id STRING, source STRING, type STRING, magnitude DOUBLE, place STRING, time STRING, "
    "longitude DOUBLE, latitude DOUBLE, depth_km DOUBLE, status STRING, tsunami INT, alert STRING, "
    "felt INT, url STRING, ingested_at STRING, significance DOUBLE"
)
NATURAL_EVENT = (
    "event_id STRING, source STRING, type STRING, title STRING, status STRING, longitude DOUBLE, "
    "latitude DOUBLE, last_date STRING, start_date STRING, geometry_count INT, ingested_at STRING"
)
DECLARATION = (
    "event_id STRING, source STRING, incident_type STRING, title STRING, state STRING, county STRING, "
    "declaration_date STRING, incident_begin STRING, incident_end STRING, fema_region INT, "
    "longitude DOUBLE, latitude DOUBLE, ingested_at STRING"
)

# Raw API pages.
EARTHQUAKE_PAYLOAD = (
    "features ARRAY<STRUCT<id: STRING, "
    "properties: STRUCT<mag: DOUBLE, place: STRING, time: BIGINT, updated: BIGINT, status: STRING, "
    "tsunami: INT, alert: STRING, felt: INT, url: STRING, sig: DOUBLE>, "
    "geometry: STRUCT<coordinates: ARRAY<DOUBLE>>>>"
)
# coordinates stay raw JSON text: their nesting depends on the geometry type
NATURAL_EVENT_PAYLOAD = (
    "events ARRAY<STRUCT<id: STRING, title: STRING, description: STRING, status: STRING, "
    "categories: ARRAY<STRUCT<id: STRING, title: STRING>>, "
    "geometry: ARRAY<STRUCT<date: STRING, coordinates: STRING>>, "
    "sources: ARRAY<STRUCT<url: STRING>>>>"
)
DECLARATION_PAYLOAD = (
    "DisasterDeclarationsSummaries ARRAY<STRUCT<disasterNumber: BIGINT, state: STRING, "
    "designatedArea: STRING, incidentType: STRING, declarationDate: STRING, declarationTitle: STRING, "
    "ihProgramDeclared: BOOLEAN, iaProgramDeclared: BOOLEAN, paProgramDeclared: BOOLEAN, "
    "hmProgramDeclared: BOOLEAN>>"
)

# One message of a topic, as the broker source yields it.
RECORD = "key STRING, value STRING, partition INT, offset BIGINT, timestamp TIMESTAMP"

# Identity of a document in each collection.
KEYS = {
    "earthquakes": ["event_id"],
    "eonet_events": ["event_id"],
    "fema_disasters": ["event_id", "county"],
}
