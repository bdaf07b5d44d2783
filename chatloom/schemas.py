"""Schemas of the data model, as DDL. They are always given, never inferred."""

MESSAGE = """id STRING, ts TIMESTAMP, author_id STRING, author_name STRING, content STRING, edited_ts TIMESTAMP,
attachments ARRAY<STRING>, num_embeds INT, type INT, referenced_id STRING, reply_to_preview STRING,
reply_to_author_id STRING, reply_to_author_name STRING, reply_to_missing BOOLEAN, folder STRING"""

TURN = """folder STRING, session_id STRING, turn_idx INT, author_id STRING, author_name STRING,
start_ts TIMESTAMP, end_ts TIMESTAMP, text STRING, source_ids ARRAY<STRING>, words INT"""

SESSION = """session_id STRING, folder STRING, first_ts STRING, last_ts STRING, authors ARRAY<STRING>,
turns ARRAY<STRUCT<author_id:STRING,author_name:STRING,start_ts:STRING,end_ts:STRING,text:STRING,source_ids:ARRAY<STRING>>>"""

SAMPLE = """system STRING, conversations ARRAY<STRUCT<`from`:STRING,value:STRING>>,
meta STRUCT<persona_id:STRING,persona_name:STRING,counterparty_ids:ARRAY<STRING>,session_id:STRING,folder:STRING,
first_ts:STRING,last_ts:STRING,num_turns:INT,end_source_ids:ARRAY<STRING>>"""

GENERATION = """persona_id STRING, persona_name STRING, reference STRING, generated STRING, system STRING,
context_turns ARRAY<STRUCT<`from`:STRING,value:STRING>>, context STRING, eval_val_jsonl STRING, eval_val_sha256 STRING"""

COMPARISON = """sample_key STRING, i INT, j INT, swap BOOLEAN, choice STRING, winner_label STRING, loser_label STRING,
parse_error BOOLEAN, checkpoint_kind STRING, error STRING, error_type STRING"""

_AUTHOR = "STRUCT<id:STRING,username:STRING,global_name:STRING>"
RAW_MESSAGE = f"""id STRING, timestamp STRING, edited_timestamp STRING, content STRING, type STRING, author {_AUTHOR},
attachments ARRAY<STRUCT<url:STRING,filename:STRING>>, embeds ARRAY<STRING>,
referenced_message STRUCT<id:STRING,content:STRING,author:{_AUTHOR}>, message_reference STRUCT<message_id:STRING>"""

RUN = """run_id STRING, created_utc STRING, label STRING, model STRUCT<name_or_path:STRING>, scores MAP<STRING,STRING>,
persona STRUCT<generations_path:STRING>, config STRUCT<val_jsonl:STRING>"""
