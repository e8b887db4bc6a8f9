"""Schemas of the tables and messages the library reads and writes, as DDL."""

RAW_WEATHER = """
    coord struct<lon: double, lat: double>,
    weather string,
    base string,
    main struct<temp: double, feels_like: double, temp_min: double, temp_max: double,
                pressure: double, humidity: double>,
    visibility double,
    wind struct<speed: double, deg: double>,
    clouds struct<`all`: double>,
    dt double,
    sys struct<type: double, id: double, country: string, sunrise: double, sunset: double>,
    timezone double,
    id double,
    name string,
    cod double,
    city_name string,
    collected_at string,
    airflow_execution_date string,
    airflow_dag_run_id string
    """

CONDITIONS = "array<struct<main: string, description: string>>"

# Both message shapes at once: nested (main, wind, weather, dt) and flat.
READING_MESSAGE = """
    city_name string,
    main struct<temp: double, humidity: double, pressure: double>,
    wind struct<speed: double>,
    weather array<struct<main: string, description: string>>,
    dt string,
    temperature double,
    humidity double,
    pressure double,
    wind_speed double,
    weather_condition string,
    timestamp string
    """

WEATHER_STREAMING = """
    city_name string, temperature double, humidity double, pressure double, wind_speed double,
    weather_condition string, timestamp timestamp, processing_time timestamp
    """

WEATHER_HOURLY = """
    city_name string, window_start timestamp, window_end timestamp, avg_temperature double,
    max_temperature double, min_temperature double, avg_humidity double, avg_pressure double,
    processing_time timestamp
    """

WEATHER_ANALYTICS = """
    city_name string, date date, metric_type string, avg_value double, min_value double,
    max_value double, std_dev double, processing_time timestamp
    """

ALERT = """
    city_name string, alert_type string, alert_level string, message string, value double,
    threshold double, timestamp timestamp
    """

OPPORTUNITY = """
    `Date` date, `Salesperson` string, `Lead Name` string, `Segment` string, `Region` string,
    `Target Close` date, `Forecasted Monthly Revenue` double, `Opportunity Stage` string,
    `Weighted Revenue` double, `Closed Opportunity` boolean, `Active Opportunity` boolean,
    `Latest Status Entry` timestamp
    """

MONTHLY_REVENUE = "year int, month int, monthly_revenue decimal(18,2)"
EMPLOYEES = "id int, name string, age int, department string, salary int"
SALES = "transaction_id int, product_id int, store_id int, quantity int, date date, region string"
PRODUCTS = "product_id int, product_name string, category string"
STORES = "store_id int, store_name string, region string"
CUSTOMERS = "customer_id int, name string, email string, signup_date date"
ORDERS = "order_id int, customer_id int, order_date date, total_amount int, updated_at timestamp"
SEED = "id int, name string, created_at date, updated_at date"
USERS = "id int, name string, email string, created_at timestamp"

SENSOR = "sensor_id int, value float, timestamp bigint"
SENSOR_PLAIN = "sensor_id int, temperature double, humidity double"
SENSOR_NESTED = """
    message_id string, sensor_id int,
    message struct<temperature: double, pressure: double, vibration: double>,
    timestamp string
    """

CLICK_V1 = """
    event_id string, user_id string, session_id string, timestamp string, page string,
    event_type string, duration_ms int, ip_address string, user_agent string, country string,
    city string, referrer string
    """
CLICK_V2 = CLICK_V1 + ", browser string, os string, device_type string"
ACTION = "user_id int, action string, timestamp bigint"

USER_RECORD = """
    id int, name string, username string, email string,
    address struct<street: string, suite: string, city: string, zipcode: string>,
    company struct<name: string, catchPhrase: string, bs: string>
    """
