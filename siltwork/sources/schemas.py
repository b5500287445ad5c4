"""Declared schemas of the files; none is inferred."""

CHOICE = "struct<label:string,text:string>"
QUESTION = (
    "question_id string, source_type string, source_id string, category string, subcategory string, question_type string, answer_mode string, difficulty int, question_text string, answer_text string, "
    f"choices array<{CHOICE}>, answer_guidance struct<accept:array<string>,do_not_accept:array<string>>, style_tags array<string>, content_tags array<string>, "
    "source_metadata struct<source_row:int,round:int,question_number:int,tournament:string,year:int,original_difficulty:double,original_quality:double,writer:string,source:string,date:string,division:string>, "
    "provenance struct<raw_file:string,parser_version:string,review_status:string>"
)
REVIEW = "review_id string, question_id string, reviewer_id string, tournament string, review_timestamp timestamp, ratings struct<quality:double,difficulty:double>, comment string, status string, source_row int, metadata map<string,string>"
CHUNK = "chunk_id string, document_id string, source_type string, title string, chapter string, section string, pages array<int>, topics array<string>, text string, char_count int, token_count_est int, metadata map<string,string>"
EXAMPLE = "example_id string, messages array<struct<role:string,content:string>>, metadata struct<source_question_id:string,split:string,duplicate_group:string>"
CELL = "file string, sheet string, ref string, row int, col int, value string, formula string"
COMMENT = "file string, sheet string, ref string, author string, text string, timestamp string, parent_id string, comment_id string, resolved string, kind string"
