import streamlit as st
q = "SELECT the best of a kind from this and that list"
r = "SELECT a FROM t a WHERE a.is_x"
