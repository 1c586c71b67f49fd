"""Schemas of the records, and the closed sets of their values."""

from __future__ import annotations

DOMAINS = ("manga", "webtoon")
DIRECTIONS = ("vertical", "horizontal")
TEXT_TYPES = ("dialogue", "caption", "sfx", "unknown")
LABEL_SOURCES = ("teacher", "human", "distilled")
SPLITS = ("train", "val", "test")

POLYGON = "array<struct<x:double,y:double>>"
PAGE_ASSET = "asset_id string, source_id string, series_id string, chapter_id string, page_index int, image_path string, sha256 string, phash string, width int, height int, fetched_at string, domain string, metadata_json string, canonical_asset_id string, is_duplicate boolean, ord bigint"
PREDICTION = f"asset_id string, series_id string, image_path string, domain string, polygon {POLYGON}, transcript string, lang string, direction string, text_type string, detection_confidence double, recognition_confidence double, script_confidence double, teacher_agreement double, min_text_height double"
MANIFEST = f"image_path string, series_id string, domain string, tile_id string, polygon {POLYGON}, transcript string, lang string, direction string, text_type string, split string, confidence double, source string"
ITEM = "struct<id:string,parentID:string,from_name:string,to_name:string,type:string,original_width:int,original_height:int,value:struct<points:array<array<double>>,polygonlabels:array<string>,text:array<string>,choices:array<string>>>"
EXPORT = f"data struct<image_path:string,series_id:string,domain:string,tile_id:string,width:int,height:int>, annotations array<struct<score:double,result:array<{ITEM}>>>, predictions array<struct<score:double,result:array<{ITEM}>>>"
WORDS = "level string, page_num string, block_num string, par_num string, line_num string, word_num string, left string, top string, width string, height string, conf string, text string"
FEED_PAGES = "pages array<struct<page:int,img:string,headerForImage:map<string,string>>>, next string, prev string"
FEED_INFO = "id string, title string, image string, description string, status string, rating string, genres array<string>, authors array<string>, chapters array<struct<id:string,title:string,isNew:boolean>>"
FEED_LATEST = "array<struct<id:string,title:string,image:string,status:string,rating:string,last_chapter:string,last_update:string>>"
