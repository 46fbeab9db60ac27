"""Column layouts of the inputs and stored tables (Spark DDL)."""

PAIRS = "instruction string, response string"
DEFECT_SPEC = "defect_type string"
LOOP_LOG = ("seq bigint, iter string, summary string, duration_sec double, "
            "tokens struct<input:double,output:double,cache_read:double,cache_create:double>")
STAGE_RECORD = "stage string, iter string, status string, duration_sec double, output string"
SCALAR_RECORD = "task_id string, series string, step bigint, value string"
FRAME = (
    "frame_id string, "
    "sources array<struct<id:string,uri:string,content_type:string,timestamp:bigint,"
    "width:int,height:int>>, "
    "rois array<struct<label:array<string>,sources:array<string>,meta:map<string,string>>>, "
    "meta struct<origin:string,texture:string,defect:string,kind:string,generator:string,"
    "parent_version:string,verified:boolean>, "
    "extra map<string,string>, run_id string")
VERSION = ("version_id string, dataset_id string, dataset string, name string, parent_id string, "
           "comment string, created timestamp, published boolean, lineage array<string>")
STATS = "version_id string, dimension string, name string, count bigint"
MODEL = ("model_id string, name string, tags array<string>, created timestamp, task_id string, "
         "version_id string, label_counts map<string,bigint>, training_rows bigint, "
         "synthetic_rows bigint, threshold double, accuracy double")

# Labels that are bookkeeping and never a class to fill.
HOUSEKEEPING = ["clean", "mask", "pending-review"]
PENDING = "pending-review"
TARGET_PER_CLASS = 60
