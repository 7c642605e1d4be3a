"""Model-table schemas (Spark SQL DDL)."""

from pyspark.sql import types as T

# fixed values: the annotation export's typed columns, in file order
ANNOTATION_FIELDS = [
    ("id", "string"), ("type", "string"), ("origin", "string"), ("to_name", "string"), ("variable", "string"),
    ("original_width", "double"), ("original_height", "double"), ("value_x", "double"), ("value_y", "double"),
    ("value_width", "double"), ("value_height", "double"), ("value_rectanglelabels", "string"),
    ("source_file", "string"), ("tag", "string"), ("value_text", "string"),
]

COCO_SCHEMA = T.StructType([
    T.StructField("images", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("file_name", T.StringType())]))),
    T.StructField("annotations", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("image_id", T.StringType()),
        T.StructField("category_id", T.IntegerType()), T.StructField("bbox", T.ArrayType(T.DoubleType())),
        T.StructField("confidence", T.DoubleType()), T.StructField("max_confidence", T.DoubleType()),
        T.StructField("isempty", T.BooleanType())]))),
])

DETECTOR_SCHEMA = T.StructType([
    T.StructField("images", T.ArrayType(T.StructType([
        T.StructField("file", T.StringType()), T.StructField("max_detection_conf", T.DoubleType()),
        T.StructField("detections", T.ArrayType(T.StructType([
            T.StructField("category", T.StringType()), T.StructField("conf", T.DoubleType()),
            T.StructField("bbox", T.ArrayType(T.DoubleType()))])))]))),
])

_RESULT = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("origin", T.StringType()), T.StructField("to_name", T.StringType()),
    T.StructField("from_name", T.StringType()),
    T.StructField("original_width", T.DoubleType()), T.StructField("original_height", T.DoubleType()),
    T.StructField("value", T.StructType([
        T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()),
        T.StructField("width", T.DoubleType()), T.StructField("height", T.DoubleType()),
        T.StructField("rectanglelabels", T.ArrayType(T.StringType())),
        T.StructField("choices", T.ArrayType(T.StringType())),
        T.StructField("text", T.ArrayType(T.StringType()))])),
])
TASK_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([T.StructField("image", T.StringType())])),
    T.StructField("predictions", T.ArrayType(T.StructType([T.StructField("result", T.ArrayType(_RESULT))]))),
    T.StructField("annotations", T.ArrayType(T.StructType([T.StructField("result", T.ArrayType(_RESULT))]))),
])

GEOJSON_SCHEMA = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType())]))]))),
])
