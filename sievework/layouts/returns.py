"""Layout of the daily returns feed.

Everything here is a fixed value: the names, types and formats are given by the feed
and by the tables read downstream, so they are stated as they are.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql.types import StructType

RAW_COLUMNS = """
id updated is_returns_portal returns_portal_id delivery_info_timezone parcellab_system_created_date
created_time courier_code courier_name tracking_number xid order_no delivery_no customer_no
destination_country_iso3 region client return_shipment is_cancelled cancelled_date is_complete
is_branch_delivery cash_on_delivery is_transport is_doorstep_delivery has_pod_identifier
has_pod_signature is_contacted is_contacted_and_bounce order_date order_time announced_dispatch_date
announced_dispatch_time promise_date refreshed_date claimed_date warehouse courier_service_level
invalid forgotten dispatch_delayed network_delayed failed_attempt sla_exceeded
customer_promise_exceeded returned_to_sender return_to_sender_date returned_reason claim_reason
current_delivery_status current_stage pickup_scheduled_date pickup_scheduled_time inbound_scan_date
inbound_scan_time qualified_delivery_attempt_date qualified_delivery_attempt_time delivery_date
delivery_time delta_between_announced_and_actual_dispatch n_days_edi_transmission_until_final_delivery
n_days_courier_inbound_until_first_attempt n_days_edi_transmission_until_first_attempt
n_days_edi_transmission_until_courier_inbound n_days_order_until_first_attempt
n_days_order_until_courier_inbound n_days_failed_until_delivered n_days_edi_transmission_customer_collected
courier_delivery_location courier_exceptions articles pod_identifier contacted_with_messages_list
custom_fields payment_type sku_number article_number article_name article_category return_quantity
article_price return_reason_code pretty_return_reason return_customer_comment
activity_monitor_last_update export_created_time
""".split()

ROW_KEY = "_row_uid"

FLAGS = """
is_returns_portal return_shipment is_cancelled is_complete is_branch_delivery cash_on_delivery
is_transport is_doorstep_delivery has_pod_identifier has_pod_signature is_contacted
is_contacted_and_bounce invalid forgotten dispatch_delayed network_delayed failed_attempt
sla_exceeded customer_promise_exceeded returned_to_sender
""".split()

TEXT_IDS = "id customer_no order_no tracking_number delivery_no xid".split()

# Columns whose values hardly repeat: a dictionary of them is built, dropped and the values written again.
MOSTLY_DISTINCT = "id order_no tracking_number articles custom_fields _row_uid".split()

DAY_COUNTS = """
delta_between_announced_and_actual_dispatch n_days_edi_transmission_until_final_delivery
n_days_courier_inbound_until_first_attempt n_days_edi_transmission_until_first_attempt
n_days_edi_transmission_until_courier_inbound n_days_order_until_first_attempt
n_days_order_until_courier_inbound n_days_failed_until_delivered
n_days_edi_transmission_customer_collected
""".split()

# output: (date column, time column)
MOMENTS = {
    "order_ts": ("order_date", "order_time"),
    "pickup_scheduled_ts": ("pickup_scheduled_date", "pickup_scheduled_time"),
    "inbound_scan_ts": ("inbound_scan_date", "inbound_scan_time"),
    "qualified_delivery_attempt_ts": ("qualified_delivery_attempt_date", "qualified_delivery_attempt_time"),
    "delivery_ts": ("delivery_date", "delivery_time"),
    "announced_dispatch_ts": ("announced_dispatch_date", "announced_dispatch_time"),
    # assumption: these two describe the same instant
    "parcellab_created_ts": ("parcellab_system_created_date", "created_time"),
}
TIMESTAMPS = {
    "updated_ts": "updated",
    "activity_monitor_last_update_ts": "activity_monitor_last_update",
}
DATES = {
    "cancelled_dt": "cancelled_date",
    "promise_dt": "promise_date",
    "return_to_sender_dt": "return_to_sender_date",
    "claimed_dt": "claimed_date",
}
PRICE = "article_price"

LIST_SOURCE, LIST_PREFIX, LIST_KEY, ITEM_KEY = "articles", "articles_json_", "article_number", "articleNo"
OBJECT_SOURCE, OBJECT_PREFIX = "custom_fields", "custom_fields_json_"

ARTICLE = """
articleNo string, productId string, articleName string, articleUrl string, articleImageUrl string,
articleBrand string, price double, articlePrice double, tax double,
priceDetails struct<pricePaid:double, pricePaidNoTax:double>, size string, sizeCode string,
color string, quantity int, returnReason string, returnReasonPath string, prettyReturnReason string,
problemDescription string, compensationMethod string, returnImages array<string>, lineNumbers string,
itemId string, sku string, barcode string, prettyProductId string, season string,
consignmentId string, weightInGrams int, siteId string, category string, articleCategory string,
productType string, keepArticle string, invoiceNo string, invoiceLineItemId string,
lineItemId string, fulfillmentOriginLocationId string, itemFulfillmentLineUniqueKey string,
condition string, prettyCondition string, countryCodeOfOrigin string, countryOfManufacture string,
harmonizedSystemCode string, requiresExtraMaterial string, returnImagesUrlList string,
shopifyFulfillmentLineItems string, shopifyLineItemId string,
customFields struct<gross_weight:string, net_weight:string, height:string, width:string, length:string>,
tracking struct<client:string, courier:string, deliveryNo:string, tracking_number:string,
warehouse:string, consignmentNo:string, market:string, transportNo:string>
"""
ARTICLE_MONEY = ["price", "articlePrice"]
ARTICLE_MONEY_NESTED = {"priceDetails": ["pricePaid", "pricePaidNoTax"]}

CUSTOM_FIELDS = """
isAdditionalLabel boolean, isManuallyAddedLabel boolean, originalCourier string, paymentMethod string,
printLabel struct<url:string, bucket:string, objectKey:string, type:string>, backupPrintLabel string,
barCode struct<url:string, bucket:string, objectKey:string, type:string>, customsDocument string,
packingSlip string, claimsDocument string, commercialInvoice string, freeReturnLabel boolean,
isWarranty boolean, isCourierPickup boolean, identityPin string, deliveryPointId string,
groupCode string, pickupDateRange string, selectedLocation string, qualityCheckExpected boolean,
shopifyReturnData string, shopifyCustomerTags string, shopifyOrderTags array<string>,
refundMethod string, labelCost string, changedAddress boolean, customerService boolean,
secondHandCustomer boolean, outboundCustomFields struct<PaymentType:string, ShipType:string,
ParcelShopId:string, isNewCustomer:boolean, ShippingAmount:double, InvoiceAddr:string,
nameNoSurname:string, carrier_id:string, ExternOrderReference:string, SalesChannel:string,
GuestFlag:string, CustomerType:string, CustomerSource:string, Tags:string, Cohort:string,
Segmentation:string, OptIn:string, InvoiceAmount:double, PaymentMode:string, OrderType:string,
LatestEvent:string, LatestEventDate:string, shortOrderNo:string, totalPrice:double,
courierServiceLevel:string, FirstPayment:string, installmentPlanDisplay:array<string>,
packslips:array<string>, productRecommendations:map<string,string>>, currency string,
currencyCode string, returnLabelsAdditional array<string>, rmaStatus string, rmaStatusReason string,
externalRMAId string, stateProvince string, returnPaymentInfo struct<amount:double, currency:string,
pspReference:string, merchantReference:string>, returnCourierFee struct<value:double, currency:string>,
pickupWindow string, pickupConfirmationCode string, totalPrice double, shortOrderNo string,
pickupWindowFormatted string
"""
PERSONAL_FIELDS = {"outboundCustomFields": ["InvoiceAddr", "nameNoSurname"]}

CHECK_COLUMNS = """
articles_match_count articles_parse_failed custom_fields_parse_failed exception_type has_exception
repair_attempted repaired
""".split()
DIAGNOSTIC_COLUMNS = "_row_uid id order_no exception_type articles custom_fields order_ts updated_ts".split()


@cache
def article_fields() -> list[str]:
    return StructType.fromDDL(ARTICLE).names


@cache
def custom_fields() -> list[str]:
    return StructType.fromDDL(CUSTOM_FIELDS).names


def base_columns() -> list[str]:
    """Raw columns, row key and the derived dates, in output order."""
    return [*RAW_COLUMNS, ROW_KEY, *MOMENTS, *TIMESTAMPS, *DATES]


def published_columns() -> list[str]:
    return [
        *base_columns(),
        *(LIST_PREFIX + f for f in article_fields()),
        *(OBJECT_PREFIX + f for f in custom_fields()),
        *CHECK_COLUMNS,
    ]
