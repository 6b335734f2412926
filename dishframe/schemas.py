"""Declared schemas of every file the sources read; nothing is inferred."""

TAG_PAIRS = "array<struct<_k:string,_v:string>>"
OSM_META = "_version string, _timestamp string, _changeset string, _uid string, _user string"
OSM_NODE = f"_id string, _lat double, _lon double, {OSM_META}, tag {TAG_PAIRS}"
OSM_ELEMENT = f"_id string, _lat string, _lon string, {OSM_META}, nd array<struct<_ref:string>>, tag {TAG_PAIRS}"

POI = (
    "type string, id string, lat double, lon double, node_refs array<string>, "
    "geometry array<struct<lat:double,lon:double>>, centroid struct<lat:double,lon:double>, "
    "missing_node_refs array<string>, tags map<string,string>"
)

_CARD = "section:string,name:string,description:string,price:string"
TOAST = f"result array<struct<item_id:string,{_CARD}>>"
CASHAPP = f"result array<struct<item_id:string,{_CARD},is_sold_out:boolean>>"
SQUARE = "result array<struct<category:string,name:string,description:string,price:string,badge:string>>"
APPFRONT = (
    "source_url string, final_url string, "
    "branch struct<single_location:boolean,branch_id:string,branch_name:string>, "
    f"result array<struct<{_CARD}>>"
)
SPOTON = f"source_url string, final_url string, result array<struct<{_CARD},is_sold_out:boolean>>"
_SIZED = "name:string,price_text:string,detail:string,default_selected:boolean"
_SIZED_GROUP = f"group_name:string,rule_text:string,options:array<struct<{_SIZED}>>"
REZKU = (
    "source_url string, final_url string, order_mode string, "
    f"items array<struct<{_CARD},is_sold_out:boolean>>, "
    f"modals map<string,struct<size_options:array<struct<{_SIZED}>>,groups:array<struct<{_SIZED_GROUP}>>,"
    f"groups_by_size:map<string,array<struct<{_SIZED_GROUP}>>>>>"
)
CLOVER = (
    "source_url string, final_url string, json_ld_used boolean, "
    "items array<struct<section:string,name:string,price:string,description:string,href:string>>, "
    "modifiers map<string,array<struct<group_name:string,rule_text:string,"
    "options:array<struct<name:string,price_text:string,input_type:string>>>>>"
)
UBER_CARDS = (
    "result array<struct<name:string,in_featured_carousel:boolean,price:string,featured_rank:int,"
    "like_percent:int,like_review_count:int,is_popular:boolean>>"
)
DOORDASH_CARD = (
    "array<struct<item_id:string,name:string,price:string,featured_rank:int,like_percent:int,"
    "like_review_count:int,description:string,section:string>>"
)
GRUBHUB = (
    "sections array<struct<title:string,items:array<struct<id:string,name:string,description:string,"
    "price:string,button_text:string>>>>"
)
GRUBHUB_BADGES = "result array<struct<item_id:string,category:string,is_best_seller:boolean>>"

_RAW_GROUP = (
    "name:string,type:string,isOptional:boolean,minNumOptions:int,maxNumOptions:int,"
    "numFreeOptions:int,selectionNode:string"
)
# The innermost nestedExtrasList stays JSON text: it must be empty (see options.assert_two_levels).
_RAW_LEAF = "name:string,unitAmount:int,description:string,defaultQuantity:int,nestedExtrasList:string"
_RAW_OPTION = (
    "name:string,unitAmount:int,description:string,defaultQuantity:int,"
    f"nestedExtrasList:array<struct<{_RAW_GROUP},options:array<struct<{_RAW_LEAF}>>>>"
)
OPTION_LISTS = f"array<struct<{_RAW_GROUP},options:array<struct<{_RAW_OPTION}>>>>"
ITEM_PAGE = f"struct<itemHeader:struct<name:string,description:string,unitAmount:int>,optionLists:{OPTION_LISTS}>"
HARVEST_ITEM = f"item_id:string,section:string,name:string,menu_position:int,item_page:{ITEM_PAGE}"
HARVEST = (
    f"source_url string, store_id string, complete boolean, items array<struct<{HARVEST_ITEM}>>, "
    f"data struct<itemPage:{ITEM_PAGE}>"
)

SEARCH_RESULTS = (
    "query string, "
    "pages array<struct<page:int,url:string,title:string,result_count:int,"
    "results:array<struct<index:int,title:string,url:string,text:string>>>>, "
    "results array<struct<index:int,page:int,title:string,url:string,text:string>>"
)
JUDGMENTS = (
    "model string, elapsed_seconds double, "
    "results array<struct<index:string,usefulness:string,useful_data_types:array<string>,"
    "what_the_result_is:string,why:string>>"
)
RUN_ERROR = "model string, elapsed_seconds double, error string"
MODEL_CATALOG = (
    "models array<struct<modelId:string,provider:string,pricePerMillionInputTokens:double,"
    "inputModalities:array<string>,maxCompletionTokens:int>>"
)
MENU_ITEM = (
    "struct<title:string,ingredients_or_description:string,price:string,special:string,"
    "featured_rank:int,like_percent:int,like_review_count:int,popular:boolean,review_flags:array<string>>"
)
MENU = f"menu_sections array<struct<section:string,items:array<{MENU_ITEM}>>>"

# schema.org menus; offers and the section lists are kept as JSON text because they vary in shape.
LD_SECTION = "name string, hasMenuItem string"
LD_ITEM = "name string, description string, offers string"
