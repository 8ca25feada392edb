import streamlit as st
st.header("H")
q = "SELECT * FROM last_table"